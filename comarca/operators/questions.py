"""Routing of questions to reports, and SQL found in answers, over tables of text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Keywords of each report, in the order that settles ties.
TEMPLATE_KEYWORDS = {
    "depopulation": ["depopulation", "depopulated", "empty", "abandoned", "despoblamiento", "despobladas"],
    "population_province": ["population", "inhabitants", "people", "province", "poblacion", "habitantes"],
    "evolution": ["evolution", "trend", "historical", "years", "change", "evolucion", "tendencia"],
    "industry": ["industry", "industrial", "sectors", "economic", "gdp", "industria", "pib"],
    "sectors": ["sector", "cnae", "activity", "employment", "empleo", "actividad"],
    "unemployment": ["unemployment", "jobless", "work", "employment", "paro", "desempleo", "trabajo"],
    "municipalities": ["municipality", "town", "city", "locality", "municipio", "pueblo", "ciudad"],
    "growth": ["growth", "grow", "increase", "rise", "crecimiento", "crecer", "aumentar"],
}

# What each report is called in an answer.
TEMPLATE_DESCRIPTIONS = {
    "depopulation": "Areas with highest depopulation index",
    "population_province": "Population by province in 2023",
    "evolution": "Evolution of total population in Spain",
    "industry": "Industrial activity by province",
    "sectors": "Economic sectors with highest activity",
    "unemployment": "Employment and unemployment rates by depopulation level",
    "municipalities": "Most populated municipalities in Spain",
    "growth": "Municipalities with highest population growth (2013-2023)",
}

# The report that answers each template, as a key of the registered queries.
TEMPLATE_REPORTS = {
    "depopulation": "topk_n",
    "population_province": "population_pivot_sex_top",
    "evolution": "evolution_since",
    "industry": "industry_gdp_top",
    "sectors": "sectors_gva",
    "unemployment": "rates_by_category",
    "municipalities": "top_municipalities",
    "growth": "growth_two_years_b",
}


def no_answer(descriptions: Mapping[str, str] = TEMPLATE_DESCRIPTIONS) -> str:
    """The description of a question that fits no template."""
    return f"No report fits. Known reports: {'; '.join(descriptions.values())}"


def route_questions(
    questions: DataFrame,
    text: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATE_KEYWORDS,
    descriptions: Mapping[str, str] = TEMPLATE_DESCRIPTIONS,
    reports: Mapping[str, str] = TEMPLATE_REPORTS,
) -> DataFrame:
    """Adds ``template``, ``score``, ``description`` and ``report``: the one most of whose keywords occur in the text.

    The first template wins ties. A text without keywords has no template and no
    report; its description lists what can be asked. Keywords and descriptions are part
    of the plan, so this is one projection without a shuffle.
    """
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    with_text = questions.withColumn("_text", lowered)
    hits = {
        name: sum((F.contains("_text", F.lit(word)).cast("int") for word in words), F.lit(0))
        for name, words in templates.items()
    }
    scored = with_text.withColumn("_scores", F.array(*hits.values()))
    best = scored.withColumn("score", F.array_max("_scores"))
    first = F.array_position("_scores", F.col("score")).cast("int")
    named = F.element_at(F.array(*[F.lit(name) for name in templates]), first)
    named = best.withColumn("template", F.when(F.col("score") > 0, named))

    def of_template(values: Mapping[str, str]) -> Column:
        return F.element_at(F.array(*[F.lit(values.get(name)).cast("string") for name in templates]), first)

    asked = F.col("score") > 0
    answered = named.withColumns(
        {
            "description": F.when(asked, of_template(descriptions)).otherwise(F.lit(no_answer(descriptions))),
            "report": F.when(asked, of_template(reports)),
        }
    )
    return answered.drop("_text", "_scores")


def fenced_sql(text: Column) -> Column:
    """First block fenced as ``sql``, else first fenced block that starts with SELECT, else NULL."""
    marked = r"(?isU)```sql\s*(.*?)\s*```"
    bare = r"(?isU)```\s*(SELECT.*?)\s*```"
    return F.when(text.rlike(marked), F.regexp_extract(text, marked, 1)).when(
        text.rlike(bare), F.regexp_extract(text, bare, 1)
    )


def last_messages(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    last: int = 4,
    roles: Sequence[str] = ("user", "assistant"),
    width: int = 500,
) -> DataFrame:
    """The last few messages of each conversation, then only the given roles, cut to ``width``.

    Spark ranks inside each task first, so at most ``last`` rows per task and
    conversation are shuffled however long a conversation is.
    """
    newest = W.partitionBy(conversation).orderBy(F.col(turn).desc())
    recent = messages.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= last)
    return recent.where(F.col("role").isin(*roles)).select(
        conversation, turn, "role", F.substring("text", 1, width).alias("content")
    )
