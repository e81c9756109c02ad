"""Manual company merge on instruction (survivor <- absorbed).

The instruction list is a headerless two-column CSV (A6). Codes are trimmed
(of all white space) on both sides and rows are paired by code (not by
position). ``run_manual_merge`` is the whole job: it reads, checks, and either
writes the next master or, when any code is bad, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.fixed import MERGE_COLUMNS, STRIPPED, ZERO_IS_GAP
from ..sources.tables import counted
from .master import delete_keys, merge_update
from .skew import grown

INSTRUCTION_SCHEMA = "survivor string, absorbed string"
_ENDS = f"^[{STRIPPED}]+|[{STRIPPED}]+$"


def stripped(c) -> Column:
    return F.regexp_replace(c, _ENDS, "")


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV, every value a string; exactly two columns."""
    raw = spark.read.options(header="false", escape='"').csv(path)
    if len(raw.columns) != 2:
        raise ValueError(f"{path}: a merge instruction file has exactly 2 columns")
    return raw.toDF("survivor", "absorbed")


def _trimmed(instr: DataFrame) -> DataFrame:
    return instr.select(stripped("survivor").alias("survivor"), stripped("absorbed").alias("absorbed"))


def check_instructions(instr: DataFrame, m_company: DataFrame) -> DataFrame:
    """(field, code, problem) for every bad code; empty means "go".

    problem: ``unknown_code`` (not in the master; both columns), and, beyond
    the original check, ``self_merge`` (survivor = absorbed), ``chain`` (an
    absorbed code that is a survivor elsewhere) and ``repeated_survivor``."""
    ins = _trimmed(instr)
    codes = m_company.select(stripped("company_code").alias("code")).filter(F.col("code").isNotNull())
    out = []
    for col in ("survivor", "absorbed"):
        bad = (ins.select(F.col(col).alias("code")).join(grown(codes), "code", "left_anti")
               .select(F.lit(col).alias("field"), "code", F.lit("unknown_code").alias("problem")))
        out.append(bad)
    out.append(ins.filter(F.col("survivor") == F.col("absorbed"))
               .select(F.lit("survivor").alias("field"), F.col("survivor").alias("code"),
                       F.lit("self_merge").alias("problem")))
    survivors = ins.select(F.col("survivor").alias("code")).filter(F.col("code").isNotNull())
    out.append(ins.select(F.col("absorbed").alias("code")).join(survivors.distinct(), "code", "left_semi")
               .select(F.lit("absorbed").alias("field"), "code", F.lit("chain").alias("problem")))
    out.append(survivors.groupBy("code").count().filter(F.col("count") > 1)
               .select(F.lit("survivor").alias("field"), "code", F.lit("repeated_survivor").alias("problem")))
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result.distinct()


def valid_instructions(instr: DataFrame, m_company: DataFrame) -> DataFrame:
    """Trimmed instruction rows that none of the E13 problems touches (for looking at a list;
    the job takes a list as a whole or not at all)."""
    ins = _trimmed(instr)
    bad = check_instructions(instr, m_company)
    bad_s = bad.filter(F.col("field") == "survivor").select(F.col("code").alias("survivor"))
    bad_a = bad.filter(F.col("field") == "absorbed").select(F.col("code").alias("absorbed"))
    return (ins.filter(F.col("survivor").isNotNull() & F.col("absorbed").isNotNull())
            .join(bad_s, "survivor", "left_anti").join(bad_a, "absorbed", "left_anti"))


def _fill(col: str, survivor: Column, absorbed: Column) -> Column:
    if col in ZERO_IS_GAP:
        return F.coalesce(F.nullif(survivor, F.lit(0)), absorbed)
    if col in fixed.COMPANY_FLAGS:
        return F.coalesce(survivor, absorbed)          # the survivor's flag stands (no OR)
    return F.coalesce(F.nullif(survivor, F.lit("")), absorbed)


def merged_rows(instr: DataFrame, m_company: DataFrame) -> DataFrame:
    """The survivors' gaps filled from the absorbed companies, which are all still there. A master
    bucketed by company_code stays where it is."""
    s = m_company.select([F.col(c).alias("s_" + c) for c in m_company.columns])
    a = m_company.select([F.col(c).alias("a_" + c) for c in m_company.columns])
    pairs = (instr.join(s, instr.survivor == s.s_company_code)
             .join(a, instr.absorbed == a.a_company_code))
    update = pairs.select(F.col("survivor").alias("company_code"),
                          *[_fill(c, F.col("s_" + c), F.col("a_" + c)).alias(c) for c in MERGE_COLUMNS])
    return merge_update(m_company, update, "company_code", MERGE_COLUMNS, order_col=None,
                        on_multi="unique")


def apply_merge(instr: DataFrame, m_company: DataFrame) -> DataFrame:
    """E14 + E15: fill the survivor's gaps from the absorbed company, then delete
    the absorbed company. Returns the next m_company state."""
    return delete_keys(merged_rows(instr, m_company), instr, "company_code", "absorbed")


def orphan_persons(m_person: DataFrame, m_company: DataFrame) -> DataFrame:
    """Persons whose company_code no longer exists (E15 keeps them)."""
    codes = m_company.select("company_code")
    return m_person.filter(F.col("company_code").isNotNull()).join(grown(codes), "company_code", "left_anti")


class BadInstructions(ValueError):
    """Some codes of a merge list are bad; ``problems`` (field, code, problem) says which."""

    def __init__(self, problems: DataFrame):
        super().__init__("the merge list has bad codes; nothing was merged")
        self.problems = problems


def run_manual_merge(spark: SparkSession, instructions: str, m_company_in: str, m_company_out: str) -> dict:
    """The manual job: every instruction of the file is applied, or none. A missing file, a
    file that has not two columns and a bad code all stop it before anything is written.
    Returns the row counts of the step."""
    instr = read_instructions(spark, instructions)
    master = spark.read.parquet(m_company_in)
    problems = check_instructions(instr, master)
    if not problems.isEmpty():
        raise BadInstructions(problems)
    rows = _trimmed(instr)
    # what happens to each row is told and counted while the snapshot is written: no job of its own
    fate = (rows.select(F.col("survivor").alias("company_code"), F.lit("updated").alias("_fate"))
            .unionByName(rows.select(F.col("absorbed").alias("company_code"), F.lit("deleted").alias("_fate")).distinct()))
    told = merged_rows(rows, master).join(fate, "company_code", "left")
    observed, obs = counted(told, "manual_merge", **{x: F.count_if(F.col("_fate") == x) for x in ("updated", "deleted")})
    left = observed.filter(F.col("_fate").isNull() | (F.col("_fate") != "deleted")).drop("_fate")
    left.write.mode("errorifexists").parquet(m_company_out)
    got = {k: int(v) for k, v in obs.get.items()}
    return {"instructions": got["updated"], "company_rows": got["rows"] - got["deleted"], "company_updated": got["updated"],
            "company_deleted": got["deleted"], "company_untouched": got["rows"] - got["updated"] - got["deleted"]}
