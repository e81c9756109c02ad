"""Configuration tables: keywords, replace pairs, prefectures.

The rows below are this project's own choice of contents (the tables are
operational data). They are small dimension tables: they are read once and
turned into Column expressions (literal lists, replace chains), never joined
row by row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import read_columns

# ---- FIXED VALUES: conf contents used by the tests and queries ------------
KEYWORD_ROWS = (
    ("1", "090"), ("1", "080"), ("1", "070"),
    ("2", "info@"), ("2", "contact@"), ("2", "sales@"),
    ("3", "代表取締役"), ("3", "社長"), ("3", "CEO"),
)
REPLACE_ROWS = (
    ("1", "‐", "-"), ("1", "–", "-"), ("1", "—", "-"),
    ("1", "―", "-"), ("1", "−", "-"),
    ("2", "(株)", "株式会社"), ("2", "㈱", "株式会社"),
    ("2", "(有)", "有限会社"), ("2", "㈲", "有限会社"),
    ("3", "-", "役職なし"), ("3", "なし", "役職なし"), ("3", "役職無し", "役職なし"),
    ("3", "平社員", "役職なし"), ("3", "ヒラ", "役職なし"),
)
PREFECTURE_NAMES = (
    "北海道", "青森県", "岩手県", "宮城県", "秋田県", "山形県", "福島県",
    "茨城県", "栃木県", "群馬県", "埼玉県", "千葉県", "東京都", "神奈川県",
    "新潟県", "富山県", "石川県", "福井県", "山梨県", "長野県", "岐阜県",
    "静岡県", "愛知県", "三重県", "滋賀県", "京都府", "大阪府", "兵庫県",
    "奈良県", "和歌山県", "鳥取県", "島根県", "岡山県", "広島県", "山口県",
    "徳島県", "香川県", "愛媛県", "高知県", "福岡県", "佐賀県", "長崎県",
    "熊本県", "大分県", "宮崎県", "鹿児島県", "沖縄県",
)
PREFECTURE_ROWS = tuple((f"{i:02d}", name) for i, name in enumerate(PREFECTURE_NAMES, start=1))

KEYWORD_SCHEMA = T.StructType([
    T.StructField("keyword_category", T.StringType()),
    T.StructField("keyword", T.StringType()),
])
REPLACE_SCHEMA = T.StructType([
    T.StructField("category_code", T.StringType()),
    T.StructField("before_string", T.StringType()),
    T.StructField("after_string", T.StringType()),
])
PREFECTURE_SCHEMA = T.StructType([
    T.StructField("prefecture_code", T.StringType()),
    T.StructField("prefecture_name", T.StringType()),
])


def conf_frames(spark: SparkSession) -> dict[str, DataFrame]:
    """The three conf tables as DataFrames (default contents)."""
    return {
        "m_keyword": spark.createDataFrame(list(KEYWORD_ROWS), KEYWORD_SCHEMA),
        "m_replace_string": spark.createDataFrame(list(REPLACE_ROWS), REPLACE_SCHEMA),
        "m_prefecture": spark.createDataFrame(list(PREFECTURE_ROWS), PREFECTURE_SCHEMA),
    }


def replace_order(pairs):
    """Application order of replace pairs: longest before_string first, then by text."""
    return sorted(pairs, key=lambda p: (-len(p[0]), p[0]))


@dataclass(frozen=True)
class Conf:
    """Conf contents as driver-side parameters for expression building."""

    keywords: dict = field(default_factory=dict)      # category -> tuple of keywords
    replaces: dict = field(default_factory=dict)      # category -> tuple of (before, after)
    prefectures: tuple = ()                           # (code, name) pairs

    def keywords_of(self, category: str) -> tuple:
        return self.keywords.get(category, ())

    def replaces_of(self, category: str) -> tuple:
        return self.replaces.get(category, ())

    @property
    def prefecture_names(self) -> tuple:
        return tuple(n for _, n in self.prefectures)

    @classmethod
    def from_rows(cls, keyword_rows, replace_rows, prefecture_rows) -> "Conf":
        kw: dict = {}
        for cat, word in keyword_rows:
            if word is not None:
                kw.setdefault(cat, []).append(word)
        rp: dict = {}
        for cat, before, after in replace_rows:
            if before is not None and before != "":
                rp.setdefault(cat, []).append((before, after if after is not None else ""))
        return cls(
            keywords={k: tuple(v) for k, v in kw.items()},
            replaces={k: tuple(replace_order(v)) for k, v in rp.items()},
            prefectures=tuple((c, n) for c, n in prefecture_rows if n is not None),
        )

    @classmethod
    def default(cls) -> "Conf":
        return cls.from_rows(KEYWORD_ROWS, REPLACE_ROWS, PREFECTURE_ROWS)

    @classmethod
    def from_frames(cls, m_keyword: DataFrame, m_replace_string: DataFrame,
                    m_prefecture: DataFrame) -> "Conf":
        """The conf tables as stored. They are parameters of the rules (their rows become
        literals of the expressions), so they are read to the driver once per run."""
        kw = m_keyword.select("keyword_category", "keyword").collect()
        rp = m_replace_string.select("category_code", "before_string", "after_string").collect()
        pf = m_prefecture.select("prefecture_code", "prefecture_name").collect()
        return cls.from_rows([tuple(r) for r in kw], [tuple(r) for r in rp], [tuple(r) for r in pf])

    @classmethod
    def stored(cls, spark: SparkSession, root: str) -> "Conf":
        """Conf tables kept as parquet under ``root`` (pruned scans)."""
        scan = lambda name, schema: read_columns(spark, f"{root}/{name}", schema.fieldNames())
        return cls.from_frames(scan("m_keyword", KEYWORD_SCHEMA), scan("m_replace_string", REPLACE_SCHEMA),
                               scan("m_prefecture", PREFECTURE_SCHEMA))


def store_conf(spark: SparkSession, root: str) -> None:
    """Write the default conf tables under ``root``."""
    for name, df in conf_frames(spark).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
