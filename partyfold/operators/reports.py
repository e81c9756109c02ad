"""Result sets behind the BI screens.

Merge candidates are reported as groups, not pairs: every member of a
candidate group is listed once with the group's anchor (smallest code) and
size, so the output grows linearly even when one block (a shared mail
provider, say) holds a third of the master.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from .skew import grown, salted_join

COMPANY_NAME_FORM = "株式会社"


def error_list(errors_by_feed: dict) -> DataFrame:
    """all error tables with a source tag."""
    frames = [df.withColumn("source", F.lit(feed)) for feed, df in errors_by_feed.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: The kept count table: one row per day, source and reason (zeros too, so that a second run of a
#: day always replaces the first), with the largest error number the source had that day.
COUNT_SCHEMA = "error_date date, source string, error_reason string, error_count bigint, last_error_seq bigint"


def daily_counts(failed: DataFrame, day, source: str) -> DataFrame:
    """Count rows of failing (row, rule) pairs whose day is the column ``day``; reasons that did not
    occur on a day that has rows are there with 0."""
    grouped = (failed.groupBy(day.alias("error_date")).agg(*[F.count_if(F.col("error_reason") == r).alias(f"r{i}")
                                                             for i, r in enumerate(fixed.ERROR_REASONS)]))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("error_reason"), F.col(f"r{i}").alias("error_count"))
                               for i, r in enumerate(fixed.ERROR_REASONS)]))
    return (grouped.select("error_date", each.alias("_c"))
            .select("error_date", F.lit(source).alias("source"), "_c.error_reason", "_c.error_count",
                    F.lit(None).cast("bigint").alias("last_error_seq")))


def replace_counts(counts: DataFrame, path: str) -> None:
    """Put count rows into the table at ``path`` in the place of those of the same days and sources."""
    (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("error_date", "source").parquet(path))


def error_trend(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """error count per day x source x reason, from the count table; no error row is read, and days
    outside the asked-for ones are not opened."""
    counts = spark.read.schema(COUNT_SCHEMA).parquet(path)
    if first_day is not None:
        counts = counts.filter(F.col("error_date") >= F.lit(first_day))
    if last_day is not None:
        counts = counts.filter(F.col("error_date") <= F.lit(last_day))
    return counts.filter("error_count > 0").select("error_date", "source", "error_reason", "error_count")


def _candidate_groups(m_company: DataFrame, key, reason: str, min_names: int = 1) -> DataFrame:
    rows = (m_company.select("company_code", "company_name", key.alias("candidate_key"))
            .filter(F.col("candidate_key").isNotNull() & (F.col("candidate_key") != "")))
    # partial aggregates: a hot key is combined map-side
    stats = (rows.groupBy("candidate_key")
             .agg(F.count(F.lit(1)).alias("group_size"), F.min("company_code").alias("anchor_code"),
                  F.count_distinct("company_name").alias("name_count"))
             .filter((F.col("group_size") > 1) & (F.col("name_count") >= min_names)))
    return (salted_join(rows, stats, ["candidate_key"], salt_from=["company_code"])
            .withColumn("reason", F.lit(reason))
            .select("reason", "candidate_key", "anchor_code", "company_code", "company_name",
                    "group_size", "name_count"))


#: Shortest name (without the form word) that a slip of the pen is looked for in.
NEAR_CHARS = 5


def near_names(m_company: DataFrame, min_chars: int = NEAR_CHARS) -> DataFrame:
    """F3, names that differ by one character (typed wrong, left out or put in) once the company-form
    word is removed. Digits do not count as slips: both names must hold the same ones. One row per
    company with such a neighbour: anchor_code is the least code under the name and its neighbours,
    group_size (and name_count) the number of these names.

    Every distinct name gives the texts that are left when one of its characters is taken out. Names
    with the same rest at the same place differ by that character alone, all of them from each
    other, so counting the group is enough; a name that equals another's rest lacks one character
    of it. No two names are compared, whatever the size of a group."""
    rows = m_company.selectExpr("company_code", "company_name", f"replace(company_name, '{COMPANY_NAME_FORM}', '') AS candidate_key")
    names = (rows.filter(F.length("candidate_key") >= min_chars).groupBy("candidate_key").agg(F.min("company_code").alias("code"))
             .withColumn("digits", F.regexp_replace("candidate_key", r"\P{Nd}", "")))
    rests = names.selectExpr("candidate_key", "code", "digits", """posexplode(transform(sequence(1, char_length(candidate_key)),
        i -> concat(substring(candidate_key, 1, i - 1), substring(candidate_key, i + 1)))) AS (place, rest)""")
    alike = ["digits", "place", "rest"]
    typed = (rests.groupBy(*alike).agg((F.count(F.lit(1)) - 1).alias("n"), F.min("code").alias("least")).filter("n > 0"))
    wrong = rests.join(grown(typed), alike).select("candidate_key", "n", "least")
    whole = names.select(F.col("candidate_key").alias("rest"), F.col("code").alias("short_code"), "digits")
    lacking = rests.select("candidate_key", "code", "digits", "rest").distinct().join(grown(whole), ["rest", "digits"])
    links = (wrong.unionByName(lacking.select("candidate_key", F.lit(1).alias("n"), F.col("short_code").alias("least")))
             .unionByName(lacking.select(F.col("rest").alias("candidate_key"), F.lit(1).alias("n"), F.col("code").alias("least"))))
    stats = (links.groupBy("candidate_key").agg((F.sum("n") + 1).alias("group_size"), F.min("least").alias("least"))
             .join(grown(names.select("candidate_key", "code")), "candidate_key")
             .select("candidate_key", "group_size", F.least("least", "code").alias("anchor_code")))
    return (salted_join(rows.filter("candidate_key <> ''"), stats, ["candidate_key"], salt_from=["company_code"])
            .select(F.lit("near_name").alias("reason"), "candidate_key", "anchor_code", "company_code", "company_name",
                    "group_size", F.col("group_size").alias("name_count")))


def candidates_name(m_company: DataFrame) -> DataFrame:
    """different names that are equal once the company-form word is removed (reason
    ``similar_name``), and names one character apart (``near_name``)."""
    key = F.replace(F.col("company_name"), F.lit(COMPANY_NAME_FORM), F.lit(""))
    return _candidate_groups(m_company, key, "similar_name", min_names=2).unionByName(near_names(m_company))


def candidates_address(m_company: DataFrame) -> DataFrame:
    """same non-empty address under more than one name (a renamed company)."""
    return _candidate_groups(m_company, F.col("full_address"), "same_address", min_names=2)


def candidates_domain(m_company: DataFrame) -> DataFrame:
    """same domain part of the main mail address."""
    mail = F.col("main_email_address")
    key = F.when(mail.contains("@"), F.substring_index(mail, "@", -1))
    return _candidate_groups(m_company, key, "same_mail_domain")


def company_list(m_company: DataFrame, prefecture_code: str | None = None,
                 name_contains: str | None = None) -> DataFrame:
    """company master list with screen filters."""
    out = m_company
    if prefecture_code is not None:
        out = out.filter(F.col("prefecture_code") == prefecture_code)
    if name_contains is not None:
        out = out.filter(F.col("company_name").contains(name_contains))
    return out


def person_list(m_person: DataFrame, m_company: DataFrame, name_contains: str | None = None,
                company_contains: str | None = None) -> DataFrame:
    """person master list with the company's name and screen filters. Persons without a
    company take no part in the join (they would all meet in one task); a company with very many
    persons is one row on the other side, which AQE's skew join splits."""
    persons = m_person
    if name_contains is not None:
        persons = persons.filter(F.col("name").contains(name_contains))
    comp = m_company.select("company_code", "company_name")
    joined = persons.filter(F.col("company_code").isNotNull()).join(grown(comp), "company_code", "left")
    alone = persons.filter(F.col("company_code").isNull()).withColumn("company_name", F.lit(None).cast("string"))
    out = joined.unionByName(alone)
    if company_contains is not None:
        out = out.filter(F.col("company_name").contains(company_contains))
    return out
