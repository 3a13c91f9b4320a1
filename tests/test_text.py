import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmatch.functions import text
from kinmatch.plans.products import masters_from_sku, preprocess, product_regex, with_base_names


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression.alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


SIZES = [
    "susu isi 3 pcs ", "gula 2 kg ", "teh 200ml ", "minyak 2 liter ", "mie 1 karton", "kopi", "x12 botol ",
    "24 x kotak ", "500 gr bubuk ", "5 g ", "9ml ", "10 sachet isi", "kardus 3 dus isi", "isi10 ", "7  x ",
]


def expected_quantity(t):
    m = re.search(text.QUANTITY_PATTERN, t)
    if m:
        return int(re.search(r"\d+", m.group()).group())
    return 12 if re.search(text.CARTON_PATTERN, t) else 1


def expected_weight(t):
    for pattern, scale in ((text.GRAM_PATTERN, 1), (text.KILOGRAM_PATTERN, 1000)):
        m = re.search(pattern, t)
        if m:
            return scale * int(re.search(r"\d+", m.group()).group())
    return None


def test_quantity_agrees_with_python_regex(spark):
    assert column(spark, SIZES, text.extract_quantity("v")) == [expected_quantity(t) for t in SIZES]


def test_weight_agrees_with_python_regex(spark):
    got = column(spark, SIZES, text.extract_weight("v"))
    assert got == [expected_weight(t) for t in SIZES]
    assert got[0] == 3000  # a bare number and a space count as kilograms


def test_weight_without_the_bare_number_form(spark):
    got = column(spark, ["isi 3 pcs ", "2 kg "], text.extract_weight("v", strict_kg=True))
    assert got == [None, 2000]


def test_volume_loses_litres_unless_fixed(spark):
    values = ["200ml ", "2 liter ", "9ml ", "tanpa"]
    assert column(spark, values, text.extract_volume("v")) == [200, None, None, None]
    assert column(spark, values, text.extract_volume("v", litre_fix=True)) == [200, 2000, None, None]


def test_display_unit_and_base_name(spark):
    masters = spark.createDataFrame(
        [
            (1, "susu 2 x 200 ml", 2.0, 200.7, 50.0, "ml", False),
            (2, "gula 500 g", 0.0, 0.0, 500.0, "g", False),
            (3, "teh", None, None, None, "g", False),
            (4, "hapus", 1.0, 0.0, 0.0, "g", True),
        ],
        "id int, name string, quantity double, volume double, weight double, uom string, is_deleted boolean",
    )
    rows = {r["id"]: r for r in with_base_names(masters).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1]["display_unit"] == " 2 x 200 ml" and rows[1]["base"] == "susu"
    assert rows[2]["display_unit"] == " 500 g" and rows[2]["base"] == "gula"
    assert rows[3]["display_unit"] == "" and rows[3]["base"] == "teh"


def test_clean_text_agrees_with_python(spark):
    values = ["  Café\\n No.1! ", None, "a_b ", "\tÉté²\x85", "x\\", "日本 (語)"]

    def expected(t):
        if t is None:
            return "none"
        return re.sub(r"[^\w\s]*", "", re.sub(r"\\.", "", t)).strip().lower()

    assert column(spark, values, text.clean_text("v")) == [expected(v) for v in values]


@pytest.mark.parametrize(
    "given,wanted",
    [("a.jpg", "a.jpg"), ("a.png", "a.jpg"), ("a.b.jpg", "a.jpg"), ("a", "a.jpg"), (".jpg", ".jpg"), ("", ".jpg")],
)
def test_normalize_filename(spark, given, wanted):
    assert column(spark, [given], text.normalize_filename("v")) == [wanted]


def test_python_number_text(spark):
    values = [0.0, 1.5, -2.25, 100.0, 12345678.0, 12345678.125, 1e15, 1e16, 1.5e16, 1e22, 0.001, 0.0001,
              0.00012345, 1e-5, -3.25e-7, float("nan"), float("inf"), -12345678901234.5, 1e100]
    got = column(spark, values, text.python_text("v", T.DoubleType()), "double")
    assert got == [str(v) for v in values]


def test_python_text_of_other_types(spark):
    assert column(spark, [True, None], text.python_text("v", T.BooleanType()), "boolean") == ["True", "nan"]
    assert column(spark, [7, None], text.python_text("v", T.LongType()), "bigint") == ["7", "nan"]


def test_preprocess_keeps_first_complete_rows(spark):
    products = spark.createDataFrame(
        [(1, "b", "d", 9, 1), (1, "a", "d", 9, 0), (2, None, "d", 9, 0), (3, "c", "d", None, 0)],
        "id int, name string, description string, master_product_id int, seq int",
    )
    masters = spark.createDataFrame(
        [(9, "M 2 x", 2.0, 0.0, 0.0, "g", False)],
        "id int, name string, quantity double, volume double, weight double, uom string, is_deleted boolean",
    )
    clean, labelled = preprocess(products, masters, order="seq")
    assert sorted((r["id"], r["name"], r["master_product_base"]) for r in clean.collect()) == [
        (1, "a", "M"), (3, "c", None)
    ]
    assert [r["id"] for r in labelled.collect()] == [1]
    without, none = preprocess(products.drop("master_product_id"), order="seq")
    assert without.count() == 2 and none.count() == 0


def test_product_regex_overwrites_weight(spark):
    df = spark.createDataFrame([(1, "Susu", "200ML kotak", 5.0)], "id int, name string, description string, weight double")
    row = product_regex(df).first()
    assert (row["quantity"], row["volume"], row["weight"]) == (1, 200, None)
    assert "__text" not in product_regex(df).columns


def test_masters_from_sku(spark):
    sku = "1234/" + "7" * 19 + "/05"
    other = "9999/" + "8" * 19 + "/01"
    rows = [(i, f"kode {sku} x") for i in range(10)] + [(20 + i, other) for i in range(3)] + [(50, "tanpa")]
    out = masters_from_sku(spark.createDataFrame(rows, "id bigint, description string")).collect()
    assert sorted(r["id"] for r in out) == list(range(1, 10))
    assert {r["master_product"] for r in out} == {0} and {r["sku"] for r in out} == {sku}


def test_first_number_overflow_is_null(spark):
    assert column(spark, ["9" * 30, "ab12"], text.first_number("v")) == [None, 12]
    assert column(spark, ["x"], F.lit("a")) == ["a"]


def test_dense_tfidf_works_out_a_row_s_length_once(spark):
    from kinmatch.operators.encode import fit_tfidf

    docs = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, None)], "id bigint, name string")
    coded = fit_tfidf(docs, "name", dims=32).transform(docs)
    # within the loop over the slots it would be worked out for each of them
    assert "aggregate(transform(" not in coded._jdf.queryExecution().optimizedPlan().toString()
    lengths = {r["id"]: None if r["vec"] is None else round(sum(x * x for x in r["vec"]), 5) for r in coded.collect()}
    assert lengths == {1: 1.0, 2: 1.0, 3: None}
