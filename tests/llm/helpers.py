"""Small tables with awkward rows, for all operators."""

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} der{i % 53}" for i in range(12_000))
AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", None, "a", 5),
    (4, "one", "en", None, 3),
    (5, "The cat sat on the mat and the dog ran to the door.", "en", "a", 51),
    (5, "The cat sat on the mat and the dog ran to the door.", "en", "a", 51),
    (6, "The cat sat on the mat and the dog ran to the door.", "en", "a", 51),
    (None, "Der Hund und die Katze sind im Haus.", "de", "a", 36),
    (7, "Der Hund und die Katze sind im Garten.", "de", "b", None),
    (8, LONG, "en", "b", len(LONG)),
    (9, "aaaa" * 20_000, "en", "b", 80_000),
    (10, "12 34 !! ??", "en", "b", 11),
]
# Names that the operators use themselves.
CLASHING = ["component_id", "root", "a", "b", "ka", "gone", "score", "at", "item", "lang_pred", "row_a", "fp", "ids"]


def awkward(spark: SparkSession, rows=None) -> DataFrame:
    rows = AWKWARD if rows is None else rows
    schema = DOCS + "".join(f", {c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)


def empty(spark: SparkSession) -> DataFrame:
    return awkward(spark, [])


def docs(spark: SparkSession, texts: dict) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], DOCS)


def ids(df: DataFrame) -> list:
    return sorted((r[0] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in AWKWARD), key=lambda x: (x is None, x))
