import pytest
from pyspark.sql import functions as F

from folioforge.functions import numeric, rounding, text, tiers

pytestmark = pytest.mark.unit


def apply(spark, inputs, kind, fn):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", fn(F.col("v")).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    "fn, cases",
    [
        (tiers.price_tier, {9.99: "Budget (<$10)", 10.0: "Standard ($10-25)", 25.0: "Standard ($10-25)", 25.01: "Premium ($25-50)",
                            50.0: "Premium ($25-50)", 50.01: "Luxury (>$50)", None: "Luxury (>$50)"}),
        (tiers.discount_tier, {0.0: "No Discount", -1.0: "No Discount", 0.01: "Low (<15%)", 14.99: "Low (<15%)", 15.0: "Medium (15-35%)",
                               35.0: "Medium (15-35%)", 35.01: "High (>35%)", None: "High (>35%)"}),
        (tiers.page_tier, {50.0: "Short (<100 pages)", 99.9: "Short (<100 pages)", 100.0: "Medium (100-300)", 200.0: "Medium (100-300)",
                           299.9: "Medium (100-300)", 300.0: "Long (300-600)", 450.0: "Long (300-600)", 599.9: "Long (300-600)",
                           600.0: "Comprehensive (600+)", 800.0: "Comprehensive (600+)"}),
        (tiers.rating_category, {2.1: "Below Average (<3.0)", 2.99: "Below Average (<3.0)", 3.0: "Average (3.0-4.0)", 3.5: "Average (3.0-4.0)",
                                 3.99: "Average (3.0-4.0)", 4.0: "Good (4.0-4.5)", 4.49: "Good (4.0-4.5)", 4.5: "Excellent (4.5+)",
                                 4.8: "Excellent (4.5+)", None: "Below Average (<3.0)"}),
    ],
)
def test_tier_boundaries(spark, fn, cases):
    assert apply(spark, list(cases), "double", fn) == list(cases.values())


def test_discount_features(spark):
    rows = [(5.0, 10.0), (10.0, 10.0), (12.0, 10.0), (5.0, 0.0), (5.0, None), (None, 10.0), (None, None)]
    df = spark.createDataFrame(rows, "price double, old double")
    amount = numeric.discount_amount(F.col("old"), F.col("price"))
    out = df.select(amount.alias("a"), numeric.discount_pct(amount, F.col("old")).alias("p")).collect()
    assert [r["a"] for r in out] == [5.0, 0.0, 0.0, 0.0, None, None, None]
    assert [r["p"] for r in out] == [50.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    unclipped = df.select(numeric.discount_amount(F.col("old"), F.col("price"), clipped=False).alias("a")).collect()
    assert unclipped[2]["a"] == -2.0


def test_value_score_and_conversion(spark):
    df = spark.createDataFrame([(4.5, 9.0), (4.5, 0.0), (None, 9.0)], "rating double, price double")
    out = df.select(numeric.value_score(F.col("rating"), F.col("price")).alias("v"), numeric.convert(F.col("price")).alias("g"))
    assert [tuple(r) for r in out.collect()] == [(0.5, 7.11), (0.0, 0.0), (0.0, 7.11)]


def test_coercion(spark):
    assert apply(spark, ["1.5", " 2 ", "N/A", "", None, "$3"], "string", numeric.to_number) == [1.5, 2.0, None, None, None, None]
    assert apply(spark, ["$1,234.50", " $2 ", "$", None], "string", numeric.money_to_number) == [1234.5, 2.0, None, None]


def test_decade_and_popularity(spark):
    assert apply(spark, [1995.0, 2021.0, 0.0], "double", numeric.decade) == ["1990s", "2020s", "0s"]
    assert apply(spark, [0.0, -5.0, None], "double", lambda v: numeric.popularity_score(F.lit(4.0), v)) == [0.0, 0.0, None]
    assert apply(spark, [9.0], "double", lambda v: numeric.popularity_score(F.lit(4.0), v)) == [9.21]


def test_title_case(spark):
    cases = {"o'neil sci-fi": "O'Neil Sci-Fi", "  two  words": "  Two  Words", "ÉCOLE été": "École Été", "": "", "a1b": "A1B", None: None}
    assert apply(spark, list(cases), "string", text.title_case) == list(cases.values())


def test_word_shape(spark):
    titles = ["a bc  def", "  lead", "", None, "tab\tand\nline", "naïve café"]
    assert apply(spark, titles, "string", text.word_count) == [3, 1, 0, 0, 3, 2]
    assert apply(spark, titles, "string", text.title_length) == [9, 6, 0, 0, 12, 10]
    assert apply(spark, ["ab cd", "", None], "string", lambda c: text.chars_per_word(text.title_length(c), text.word_count(c))) == [2.5, 0.0, 0.0]
    assert apply(spark, ["a: b", "a-b", "ab", None], "string", text.has_subtitle) == [1, 1, 0, 0]


def test_text_helpers(spark):
    assert apply(spark, ["  x ", " \t ", None, "abcdef"], "string", lambda c: text.clean_text(c, 3)) == ["x", None, None, "abc"]
    assert apply(spark, ["Paperback", "PAPERBACK", "Hard", None], "string", lambda c: text.equals_ignore_case(c, "paperback")) == [1, 1, 0, 0]
    assert apply(spark, ["x" * 30, "x" * 31], "string", lambda c: text.ellipsis(c, 27, 30)) == ["x" * 30, "x" * 27 + "..."]
    assert apply(spark, ["Sci-Fi", "TeenYoungAdult"], "string", text.display_label) == ["Sci Fi", "Teen Young Adult"]
    assert apply(spark, ["9781234567890", "978123456789", "97812345678901", "X781234567890", None], "string",
                 lambda c: text.digits_between(c, 13, 13)) == [True, False, False, False, False]
    assert apply(spark, ["1234567890", "123456789"], "string", lambda c: text.digits_between(c, 10, 13)) == [True, False]
    assert apply(spark, ["Art-Modern", "Art", None], "string", text.parent_category) == ["Art", "Art", None]
    assert apply(spark, ["dataset/M/1.jpg", None], "string", text.swap_path_prefix) == ["book-covers/M/1.jpg", None]
    assert apply(spark, ["dataset\\M\\1.jpg", "a/b"], "string", lambda c: text.path_parts(c)[1]) == ["1.jpg", None]


def test_first_item(spark):
    df = spark.createDataFrame([(["a", "b"], "s"), ([], None), (None, "t")], "l array<string>, s string")
    out = df.select(text.first_item(F.col("l"), True).alias("l"), text.first_item(F.col("s"), False).alias("s")).collect()
    assert [tuple(r) for r in out] == [("a", "s"), (None, None), (None, "t")]


def test_stable_round_ignores_sum_noise(spark):
    noisy = [0.125, 0.1 + 0.2, 1.005, 1.00499999999, float("nan"), 1e300, None]
    out = apply(spark, noisy, "double", lambda c: rounding.stable_round(c, 2))
    assert out[:4] == [0.13, 0.3, 1.01, 1.0]
    assert apply(spark, [0.12344999996, 10.0 * 0.1235], "double", lambda c: rounding.stable_round(c, 4)) == [0.1234, 1.235]
    assert out[5] == 1e300 and out[6] is None


def test_exact_sums_keep_small_and_large_values(spark):
    for rows, total in (([0.004, 0.004], 0.008), ([1e17, 1.0], 1e17 + 1), ([1e30, 1e30], 2e30), ([0.1] * 10, 1.0), ([None], None)):
        df = spark.createDataFrame([(v,) for v in rows], "v double").repartition(3)
        whole, mean = df.agg(rounding.exact_sum(F.col("v")), rounding.exact_mean(F.col("v"))).first()
        assert whole == total and mean == (None if total is None else total / len(rows))
        parts = df.agg(*rounding.sum_parts(F.col("v"), "p"))
        assert parts.agg(rounding.sum_of_parts("p")).first()[0] == total
