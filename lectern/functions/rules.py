"""Rule tables and the columns they make: buckets, routing, boolean searches."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Buckets by the first label with a pattern in the lower-cased title. Fixed values; patterns with capitals can't match.
EXPOSURE_BUCKETS = {
    "Air pollution": [r"air pollution", r"particulate", r"PM2\.5", r"PM10", r"black carbon", r"traffic", r"nitrogen dioxide", r"NO2", r"wildfire", r"ultra low emission", r"ULEZ", r"ozone", r"endotoxin", r"smok(?!(e|ing)\s+(cessation|quit))"],
    "Metals / lead": [r"\blead\b", r"blood lead", r"mercury", r"arsenic", r"cadmium", r"manganese", r"metals?"],
    "Chemicals / EDC": [r"perfluoro", r"PFAS", r"PFOA", r"PFOS", r"alkylphenol", r"bisphenol", r"phthalate", r"persistent organic pollut", r"\bPOP[s]?\b", r"pesticide", r"insecticide", r"organochlor", r"DDE", r"DDT", r"endocrine disrupt", r"pyrethroid", r"paraben", r"triclosan"],
    "Prenatal / perinatal": [r"prenatal", r"gestational", r"maternal", r"in utero", r"fetal", r"perinatal", r"pregnancy"],
    "SDOH / neighborhood": [r"social determinants", r"deprivation", r"neighborhood", r"built environment", r"socioeconomic", r"foster care", r"adverse childhood experience", r"\bACE[s]?\b", r"inequality", r"disparit"],
    "Tobacco / e-cig": [r"electronic cigarette", r"e-cig", r"tobacco", r"secondhand smoke", r"nicotine", r"maternal smoking"],
}
OUTCOME_BUCKETS = {
    "Respiratory": [r"asthma", r"respiratory", r"lung function", r"wheez", r"FEV", r"airway", r"pulmonary"],
    "Neurodevelopment": [r"neurodevelop", r"cognit", r"intelligence", r"IQ", r"intellectual", r"autism", r"behavior", r"behaviour", r"neurobehavior", r"mental", r"psychomotor"],
    "Growth / birth": [r"birth weight", r"fetal growth", r"preterm", r"gestational age", r"small for gestational", r"low birth", r"BMI", r"obesity", r"adipos", r"growth", r"birth outcome"],
    "Metabolic / endocrine": [r"diabet", r"glucose", r"insulin", r"cardiometabolic", r"metabolic", r"thyroid", r"puberty", r"lipid"],
    "Renal / other": [r"renal", r"glomerular", r"kidney"],
    "Behavioral / social": [r"suicid", r"adverse childhood", r"foster care", r"wear-and-tear", r"stress"],
    "Methods / characterization": [r"metabolome", r"exposome", r"reference", r"characterization", r"quality control", r"biomarker"],
}
OTHER = "Other / mixed"

#: Titles and journals that route a paper out of the corpus. Fixed values.
REVIEW_TITLE = r"(?i)\b(review|systematic review|meta.analysis|bibliometric|narrative review|scoping review|overview|commentary|perspective|editorial|protocol|roadmap|journal club|educational|tutorial|primer|poster)\b"
EPIGENOME_TITLE = r"(?i)\b(epigenome.wide|methylation|DNA methyl|CpG|histone)\b"
CONFERENCE_TITLE = r"(?i)^(P-\d+\.|SAT-\d+|SUN-\d+|MON-\d+|TUE-\d+|THU-\d+|\d{4,5}\s)"
CONFERENCE_JOURNALS = ["innov aging", "j clin transl sci", "open forum infect dis", "j endocr soc"]

#: Words of the search queries. Fixed values.
NEGATIVE = ["systematic", "meta-analysis", "bibliometric", "protocol", "narrative review", "dementia", "Alzheimer", "midlife", "mid-life", "older adults", "menopause", "postmenopausal", "late-onset"]
NEGATIVE_TYPES = ["Review", "Congress", "Published Erratum"]
RECORDS = ["electronic health record", "electronic medical record", "EHR", "EMR", "claims data", "administrative health data", "health records"]
PEDIATRIC = ["pediatric", "paediatric", "child", "children", "childhood", "infant", "newborn", "neonatal", "adolescent", "adolescence", "youth", "early life", "pediatrics"]
UPTAKE = ["uptake", "coverage", "hesitancy", "attitudes", "perceptions", "acceptance", "knowledge"]
VACCINE_WORDS = ["vaccine", "vaccines", "vaccination", "immunization", "immunisation"]
RECORD_WORDS = ["ehr", "emr", "claims", "admin", "administrative"]


@dataclass(frozen=True)
class Search:
    """A boolean search: a phrase of every group, none of the barred ones; title_groups look at the title only."""

    tier: int
    groups: list[list[str]]
    barred: list[str] = field(default_factory=list)
    title_groups: list[list[str]] = field(default_factory=list)


_COHORT = ["birth cohort", "cohort", "linked data"]
#: The searches of the corpus by tier, each also asking for PEDIATRIC and barring NEGATIVE. Fixed values.
SEARCHES = [
    Search(1, [["environment-wide association", "exposome-wide association"]]),
    Search(1, [["exposome"], ["association", "risk"]]),
    Search(2, [RECORDS, ["environmental exposure"], ["association", "health"]]),
    Search(2, [RECORDS, ["air pollution"], ["cohort", "association"]]),
    Search(2, [RECORDS, ["chemical exposure"], ["health"]]),
    Search(2, [RECORDS, ["neighborhood environment"]]),
    Search(2, [RECORDS, ["built environment"], ["health"]]),
    Search(2, [RECORDS, ["social determinants of health"]]),
    Search(2, [RECORDS, ["prenatal"], ["exposure"]]),
    Search(3, [RECORDS, ["deprivation index", "area deprivation"]]),
    Search(3, [RECORDS, ["geospatial", "geocod"], ["exposure"]]),
    Search(4, [["exposome", "environment-wide association"], [*_COHORT, "administrative data"]]),
    Search(4, [["prenatal exposure", "prenatal exposome", "early-life exposure", "early life exposome"], ["association", "risk"]]),
    Search(4, [["air pollution", "particulate matter", "PM2.5"], _COHORT, ["asthma", "respiratory", "birth"]]),
    Search(4, [["blood lead", "chemical exposure", "endocrine disruptor"], ["cohort", "linked data", "administrative data"]]),
    Search(4, [RECORDS, ["birth cohort", "linked data"], ["exposure"]]),
    Search(5, [["vaccine", "vaccination", "immunization", "immunisation"], ["adverse event", "febrile seizure", "vaccine safety", "vaccine-associated"]], UPTAKE),
    Search(5, [["vaccine safety", "safety", "reactogenicity", "adverse event", "febrile seizure", "following immunization"]], UPTAKE, [["MMR", "DTaP", "BCG vaccine", "rotavirus vaccine", "HPV vaccine", "human papillomavirus vaccine", "human papillomavirus vaccination", "influenza vaccine"]]),
    Search(5, [["vaccine safety", "vaccine schedule", "vaccination schedule"], ["cohort", "linked data", "administrative data", "claims"]], UPTAKE),
]


def first_bucket(title: Column, table: dict[str, list[str]], other: str = OTHER) -> Column:
    """The first label, in declared order, of which a pattern is in the lower-cased title."""
    lower = F.lower(title)
    out = F
    for label, patterns in table.items():
        out = out.when(reduce(lambda a, b: a | b, [lower.rlike(p) for p in patterns]), label)
    return F.coalesce(out.otherwise(other), F.lit(other))


def phrase(term: str) -> str:
    """A term as it stands in words_only text, with the blanks around it."""
    return f" {re.sub('[^a-z0-9]+', ' ', term.lower()).strip()} "


def words_only(text: Column) -> Column:
    """Lower-case words with one blank between them and at the ends, so that whole phrases are found by contains."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), F.lit(" "))


def any_of(words: Column, terms: list[str]) -> Column:
    """Whether any of the terms is in a text made by words_only. Plain search: far cheaper than a pattern of all terms."""
    return reduce(lambda a, b: a | b, [F.contains(words, F.lit(phrase(t))) for t in terms])


def matches(search: Search, title: Column, both: Column) -> Column:
    """Whether a paper answers a search; title and both (title and body) come from words_only."""
    wanted = [any_of(title, g) for g in search.title_groups] + [any_of(both, g) for g in [*search.groups, PEDIATRIC]]
    return reduce(lambda a, b: a & b, wanted) & ~any_of(both, [*NEGATIVE, *search.barred])


def barred_type(pubtype: Column) -> Column:
    """Whether a list of publication types has one that no search takes."""
    return F.coalesce(F.arrays_overlap(pubtype, F.array(*map(F.lit, NEGATIVE_TYPES))), F.lit(False))


def _hits(df: DataFrame, title: str, body: str, pubtype: str | None) -> tuple[DataFrame, Column]:
    """df with the words of its texts, made once a row in a projection of their own, and the numbers of the searches met."""
    head = F.coalesce(F.col(title), F.lit(""))
    texts = df.select("*", words_only(head).alias("_title"), words_only(F.concat_ws(" ", head, F.col(body))).alias("_both"))
    taken = ~barred_type(F.col(pubtype)) if pubtype else F.lit(True)
    numbers = F.array(*[F.when(taken & matches(s, F.col("_title"), F.col("_both")), F.lit(i)) for i, s in enumerate(SEARCHES, 1)])
    return texts, F.filter(numbers, lambda x: x.isNotNull())


def with_tiers(df: DataFrame, title: str, body: str, name: str = "tiers", pubtype: str | None = None) -> DataFrame:
    """df plus the tiers of the searches that a paper answers, in order, each once; nulls count as empty.

    pubtype names a list of publication types: a paper with one of NEGATIVE_TYPES answers none.
    """
    texts, hits = _hits(df, title, body, pubtype)
    tiers = F.array(*[F.lit(s.tier) for s in SEARCHES])
    return texts.withColumn(name, F.array_sort(F.array_distinct(F.transform(hits, lambda i: F.get(tiers, i - 1))))).drop("_title", "_both")


def search_hits(df: DataFrame, title: str, body: str, pubtype: str | None = None) -> DataFrame:
    """A row of df for each of the 19 searches that it answers, with the search's number and tier: what a union over all searches is made of."""
    texts, hits = _hits(df, title, body, pubtype)
    tiers = F.array(*[F.lit(s.tier) for s in SEARCHES])
    return texts.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(hits).alias("search")).withColumn("tier", F.get(tiers, F.col("search") - 1))


def route(title: Column, journal: Column, pubtype: Column) -> Column:
    """review, epigenome, conference or ok; the first that holds. pubtype is one joined text."""
    name = F.coalesce(title, F.lit("N/A"))
    lower = F.lower(name)
    review = name.rlike(REVIEW_TITLE) | F.contains(F.coalesce(pubtype, F.lit("")), F.lit("Review"))
    epigenome = name.rlike(EPIGENOME_TITLE) & ~lower.contains("environment-wide") & ~lower.contains("exposome")
    conference = name.rlike(CONFERENCE_TITLE) | F.lower(F.coalesce(journal, F.lit("N/A"))).isin(CONFERENCE_JOURNALS)
    return F.when(review, "review").when(epigenome, "epigenome").when(conference, "conference").otherwise("ok")
