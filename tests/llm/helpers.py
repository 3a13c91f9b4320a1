"""Awkward documents that every operator has to take, and a few comparisons."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and" for i in range(40_000))
ROWS = [
    (0, "The cat sat on the mat and saw the dog.", "en", "a", 39),
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, "   \t\n ", "de", "b", 6),
    (4, "Der Hund und die Katze sitzen auf der Matte.", "de", "b", 44),
    (4, "Der Hund und die Katze sitzen auf der Matte.", "de", "b", 44),
    (5, LONG, "en", "c", len(LONG)),
    (6, "12 34 !!", "en", "a", 8),
    (None, "A text without an id, in English.", "en", "a", 33),
    (7, "日本語 wörds \u0085 ñ <|endoftext|> 's", "de", None, 20),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows=ROWS):
    """The documents over several partitions, with a column that clashes with the operators' own names."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(df):
    """Extra columns named like what operators add or use inside."""
    names = ("score", "lang_pred", "fingerprint", "component_id", "spans", "items", "longest", "n_words", "start", "length",
             "ids", "p_toxic", "p_low_quality", "licences", "sentences", "row", "key", "fp", "__id", "rep")
    return df.withColumns({n: F.lit("x") for n in names})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
