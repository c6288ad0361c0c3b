"""Equivalent SQL of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

from folioforge.sources.tables import CATALOG_SQL, RECORD_SQL


def r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,11)), {digits}) AS DOUBLE)"


def xsum(expr: str) -> str:
    return f"CAST(CAST(sum(CAST({expr} AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE)"


def xmean(expr: str) -> str:
    return f"({xsum(expr)} / nullif(count({expr}), 0))"


def price_tier(c: str) -> str:
    return (
        f"CASE WHEN {c} < 10 THEN 'Budget (<$10)' WHEN {c} <= 25 THEN 'Standard ($10-25)' "
        f"WHEN {c} <= 50 THEN 'Premium ($25-50)' ELSE 'Luxury (>$50)' END"
    )


def discount_tier(c: str) -> str:
    return (
        f"CASE WHEN {c} <= 0 THEN 'No Discount' WHEN {c} < 15 THEN 'Low (<15%)' "
        f"WHEN {c} <= 35 THEN 'Medium (15-35%)' ELSE 'High (>35%)' END"
    )


def money(c: str) -> str:
    return f"try_cast(trim(regexp_replace({c}, '[$,]', '', 'g')) AS DOUBLE)"


RAW = f"raw AS ({CATALOG_SQL.format(part='part')})"
STD = f"""{RAW}, std AS (
  SELECT ingest_seq, trim(isbn) AS isbn, nullif(trim(name), '') AS title, author, format, category,
         {money('price')} AS price, {money('old_price')} AS old_price,
         try_cast(trim(book_depository_stars) AS DOUBLE) AS rating, img_paths
  FROM raw)"""
FILLED = f"""{STD}, filled AS (
  SELECT ingest_seq, isbn, title, coalesce(author, 'Unknown') AS author, coalesce(format, 'Unknown') AS format,
         coalesce(category, 'Unknown') AS category, coalesce(old_price, price) AS old_price,
         coalesce(price, (SELECT quantile_cont(price, 0.5) FROM std)) AS price,
         coalesce(rating, (SELECT rating FROM std WHERE rating IS NOT NULL GROUP BY rating
                           ORDER BY count(*) DESC, rating LIMIT 1), 4.0) AS rating, img_paths
  FROM std)"""
DEDUP = f"""{FILLED}, dedup AS (
  SELECT * REPLACE (coalesce(trim(isbn), '') AS isbn) FROM filled
  QUALIFY row_number() OVER (PARTITION BY coalesce(trim(isbn), '') ORDER BY ingest_seq) = 1)"""
FEAT = f"""{DEDUP}, priced AS (
  SELECT *, {r('CASE WHEN old_price - price < 0 THEN 0.0 ELSE old_price - price END', 2)} AS discount_amount FROM dedup
), pct AS (
  SELECT *, coalesce({r('discount_amount / nullif(old_price, 0) * 100', 2)}, 0.0) AS discount_pct FROM priced
), feat AS (
  SELECT *, {r('price * CAST(0.79 AS DOUBLE)', 2)} AS price_gbp,
         coalesce({r('rating / nullif(price, 0)', 4)}, 0.0) AS value_score,
         rating >= 4.5 AS is_bestseller,
         regexp_full_match(isbn, '[0-9]{{13}}') AS isbn13_valid,
         CAST(coalesce(length(title), 0) AS INTEGER) AS title_length,
         CAST(CASE WHEN title IS NULL THEN 0 ELSE len(string_split(title, ' ')) END AS INTEGER) AS word_count,
         {price_tier('price')} AS price_tier, {discount_tier('discount_pct')} AS discount_tier
  FROM pct)"""

REC_FLAT = f"""rawrec AS ({RECORD_SQL.format(part='part')}), flat AS (
  SELECT ingest_seq, key AS ol_key, title, author, publisher, isbn, subject, CAST(first_publish_year AS DOUBLE) AS publish_year,
         CAST(number_of_pages_median AS DOUBLE) AS pages, ratings_average AS avg_rating,
         CAST(ratings_count AS DOUBLE) AS rating_count, _source AS api_source
  FROM rawrec)"""
REC_DEDUP = f"""{REC_FLAT}, recfilled AS (
  SELECT ingest_seq, ol_key, coalesce(title, 'Unknown Title') AS title, coalesce(author, 'Unknown Author') AS author,
         coalesce(publisher, 'Unknown Publisher') AS publisher, coalesce(isbn, '') AS isbn,
         coalesce(subject, 'General') AS subject, api_source,
         coalesce(publish_year, (SELECT quantile_cont(publish_year, 0.5) FROM flat)) AS publish_year,
         coalesce(pages, (SELECT quantile_cont(pages, 0.5) FROM flat)) AS pages,
         coalesce(avg_rating, (SELECT quantile_cont(avg_rating, 0.5) FROM flat)) AS avg_rating,
         coalesce(rating_count, (SELECT quantile_cont(rating_count, 0.5) FROM flat)) AS rating_count
  FROM flat
), once AS (
  SELECT * FROM recfilled QUALIFY row_number() OVER (PARTITION BY ol_key ORDER BY ingest_seq) = 1
), recdedup AS (
  SELECT * FROM once WHERE isbn = ''
  UNION ALL
  SELECT * FROM (SELECT * FROM once WHERE isbn <> '' QUALIFY row_number() OVER (PARTITION BY isbn ORDER BY ingest_seq) = 1))"""


def fence(column: str, table: str) -> str:
    return (
        f"(SELECT quantile_cont({column}, 0.25) - 1.5 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) FROM {table}) AS {column}_lo, "
        f"(SELECT quantile_cont({column}, 0.75) + 1.5 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) FROM {table}) AS {column}_hi"
    )


def clip(c: str) -> str:
    return f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END"


REC_FACT = f"""{REC_DEDUP}, recfence AS (
  SELECT {fence('pages', 'recdedup')}, {fence('avg_rating', 'recdedup')}, {fence('rating_count', 'recdedup')}
), fact AS (
  SELECT ol_key, isbn, title, author, publisher, subject, publish_year,
         CAST(CAST(floor(publish_year / 10) * 10 AS INTEGER) AS VARCHAR) || 's' AS publish_decade,
         {clip('pages')} AS pages,
         CASE WHEN pages < 100 THEN 'Short (<100 pages)' WHEN pages < 300 THEN 'Medium (100-300)'
              WHEN pages < 600 THEN 'Long (300-600)' ELSE 'Comprehensive (600+)' END AS page_tier,
         {clip('avg_rating')} AS avg_rating, {clip('rating_count')} AS rating_count,
         CAST(avg_rating >= 4.0 AS INTEGER) AS is_highly_rated,
         CASE WHEN avg_rating >= 4.5 THEN 'Excellent (4.5+)' WHEN avg_rating >= 4.0 THEN 'Good (4.0-4.5)'
              WHEN avg_rating >= 3.0 THEN 'Average (3.0-4.0)' ELSE 'Below Average (<3.0)' END AS rating_category,
         CAST(regexp_full_match(isbn, '[0-9]{{10,13}}') AS INTEGER) AS has_isbn,
         {r('avg_rating * ln(1 + greatest(rating_count, 0))', 3)} AS popularity_score,
         CAST(len(string_split(title, ' ')) AS INTEGER) AS title_word_count, api_source
  FROM recdedup, recfence)"""

SALES = """sales AS (
  SELECT l.*, p_name, p_brand, p_type, p_size, s_name, r_name FROM lineitem l
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
SALES_MEASURES = (
    f"count(*) AS row_count, {r(xmean('l_extendedprice'), 2)} AS avg_l_extendedprice, "
    f"{r(xmean('l_quantity'), 2)} AS avg_l_quantity"
)
CUBE_MEASURES = (
    f"count(*) AS row_count, {xsum('l_extendedprice')} AS sum_l_extendedprice, "
    f"{r(xmean('l_extendedprice'), 2)} AS avg_l_extendedprice, {r(xmean('l_quantity'), 2)} AS avg_l_quantity"
)
SNAPSHOTS = """old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'), new AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice + 1, 2) ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01')"""
UPSERTED = f"""{SNAPSHOTS}, merged AS (
  SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new)"""
DIFF = f"""{SNAPSHOTS}, diff AS (
  SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
    CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE'
         WHEN o.o_totalprice = n.o_totalprice THEN 'UNCHANGED' ELSE 'UPDATE' END AS op,
    CAST(o.o_custkey AS VARCHAR) AS a1, CAST(n.o_custkey AS VARCHAR) AS b1, o.o_orderstatus AS a2, n.o_orderstatus AS b2,
    CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS a3, CAST(CAST(n.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS b3
  FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey)"""
REPORT_NULLS = ["isbn", "title", "author", "format", "price", "old_price"]
REPORT_NUMERIC = ["price", "old_price", "rating", "discount_pct"]
CATALOG_NUMBERS = [
    "price", "old_price", "rating", "discount_amount", "discount_pct", "price_gbp", "value_score", "title_length", "word_count",
]
CATALOG_COLUMNS = [
    "title", "author", "format", "category", "isbn", *CATALOG_NUMBERS, "is_bestseller", "isbn13_valid", "price_tier", "discount_tier",
]
PCA_FEATURES = ["price", "rating", "old_price", "discount_pct", "value_score"]
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def grade(pct: str, warn: float, fail: float) -> str:
    return f"CASE WHEN {pct} < {warn} THEN 'PASS' WHEN {pct} < {fail} THEN 'WARN' ELSE 'FAIL' END"


def _report(nulls=REPORT_NULLS, numeric=REPORT_NUMERIC) -> str:
    parts = []
    for c in nulls:
        pct = f"(SELECT {r(f'count(*) FILTER ({c} IS NULL) * 100.0 / greatest(count(*), 1)', 2)} FROM feat)"
        parts.append(f"SELECT 'Null Check' AS \"check\", '{c}' AS column_name, {grade(pct, 5, 20)} AS status, {pct} AS value")
    for c in numeric:
        parts.append(f"SELECT 'Schema Validation', '{c}', 'PASS', CAST(0 AS DOUBLE)")
    for c in numeric:
        pct = (
            f"(SELECT {r(f'count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) * 100.0 / greatest(count({c}), 1)', 2)} "
            f"FROM feat, (SELECT {fence(c, 'feat')}))"
        )
        parts.append(f"SELECT 'Outlier Detection', '{c}', {grade(pct, 5, 15)}, {pct}")
    parts.append(
        "SELECT 'Duplicate Check', 'ALL', CASE WHEN d = 0 THEN 'PASS' ELSE 'WARN' END, CAST(d AS DOUBLE) FROM "
        "(SELECT (SELECT count(*) FROM feat) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (ingest_seq) FROM feat)) AS d)"
    )
    pct = f"(SELECT {r('count(*) FILTER (NOT isbn13_valid) * 100.0 / greatest(count(*), 1)', 2)} FROM feat)"
    parts.append(f"SELECT 'ISBN-13 Validation', 'isbn', {grade(pct, 1, 10)}, {pct}")
    return f"{FEAT}, report AS ({union(parts)})"


def _profile(table: str, column: str) -> str:
    q = [f"quantile_cont({column}, {p})" for p in (0.25, 0.5, 0.75, 0.9)]
    fields = {
        "mean": f"avg({column})", "median": q[1], "std": f"stddev_samp({column})", "skew": f"skewness({column})",
        "kurt": f"kurtosis({column})", "min": f"min({column})", "max": f"max({column})",
        "q25": q[0], "q75": q[2], "q90": q[3], "iqr": f"{q[2]} - {q[0]}",
    }
    shown = ", ".join(f"{r(f'CAST({e} AS DOUBLE)', 3)} AS {k}" for k, e in fields.items())
    return f"SELECT '{column}' AS column_name, count({column}) AS n, {shown} FROM {table}"


def _histogram(expr: str, table: str, bins: int) -> str:
    return f"""WITH v AS (SELECT {expr} AS x FROM {table}),
    s AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM v),
    c AS (SELECT CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM v, s GROUP BY 1)
    SELECT CAST(g.bin AS INTEGER) AS bin, {r('lo + (g.bin + 0.5) * w', 2)} AS centre, coalesce(n, 0) AS count
    FROM (SELECT unnest(range({bins})) AS bin) g CROSS JOIN s LEFT JOIN c ON g.bin = c.bin"""


def _corr() -> str:
    parts = []
    for a in LINE_MEASURES:
        for b in LINE_MEASURES:
            value = "CAST(1 AS DOUBLE)" if a == b else r(f"corr({a}, {b})", 2)
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {value} AS r FROM lineitem HAVING count(*) > 0")
    return union(parts)


def _outliers() -> str:
    parts = []
    for c in LINE_MEASURES:
        parts.append(
            f"SELECT '{c}' AS column_name, outliers, pct, CASE WHEN pct < 5 THEN 'Normal' WHEN pct < 15 THEN 'Moderate' ELSE 'High' END AS severity "
            f"FROM (SELECT count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) AS outliers, "
            f"{r(f'count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) * 100.0 / greatest(count({c}), 1)', 2)} AS pct "
            f"FROM lineitem, (SELECT {fence(c, 'lineitem')}))"
        )
    return union(parts)


def _cap() -> str:
    parts = []
    for c in ("l_quantity", "l_extendedprice"):
        parts.append(
            f"SELECT '{c}' AS column_name, {r(f'min({c}_lo)', 4)} AS lower, {r(f'min({c}_hi)', 4)} AS upper, "
            f"count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) AS capped, "
            f"round(CAST(sum(CAST({clip(c)} AS DECIMAL(28,6))) AS DOUBLE), 2) AS capped_sum "
            f"FROM lineitem, (SELECT {fence(c, 'lineitem')})"
        )
    return union(parts)


def _value_counts() -> str:
    columns = ["l_returnflag", "l_linestatus", "l_quantity", "l_suppkey"]
    long = union([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lineitem WHERE {c} IS NOT NULL" for c in columns])
    return f"""WITH long AS ({long}), counts AS (SELECT column_name, value, count(*) AS rows FROM long GROUP BY ALL)
    SELECT column_name, value, rows, count(*) OVER (PARTITION BY column_name) AS distinct_values FROM counts
    QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, value) <= 15"""


def _nulls(columns: dict[str, str]) -> str:
    return union(
        [
            f"SELECT '{name}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing, "
            f"{r(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)', 2)} AS missing_pct FROM raw"
            for name, c in columns.items()
        ]
    )


RAW_COLUMNS = [
    "ingest_seq", "isbn", "name", "author", "format", "category", "price", "old_price", "book_depository_stars", "img_paths",
]
RAW_NULLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in RAW_COLUMNS)


def _title_case(expr: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({expr}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


RULES = {
    "missing_isbn": "isbn IS NULL",
    "bad_price": "coalesce(price <= 0, true)",
    "bad_isbn": "isbn IS NOT NULL AND NOT regexp_full_match(isbn, '[0-9]{13}')",
}
ANY_RULE = " OR ".join(f"({c})" for c in RULES.values())

STAR = f"""WITH {FEAT} SELECT category AS category_name, format AS format_name, category || ' House' AS publisher_name, 'UK' AS region,
        count(*) AS row_count, {r(xmean('price'), 2)} AS avg_price, {r(xmean('rating'), 2)} AS avg_rating,
        CAST(sum(CAST(is_bestseller AS INTEGER)) AS BIGINT) AS bestsellers FROM feat GROUP BY ALL"""


def _two_components(table: str, columns: list[str]) -> str:
    """Share of the two largest eigenvalues of the correlation matrix: the projector on the first is a high power of it."""
    n = range(1, len(columns) + 1)
    corr = ", ".join("[" + ", ".join("1.0" if a == b else f"corr({a}, {b})" for b in columns) + "]" for a in columns)
    product = "[" + ", ".join("[" + ", ".join(" + ".join(f"m[{i}][{k}] * m[{k}][{j}]" for k in n) for j in n) + "]" for i in n) + "]"
    trace = " + ".join(f"m[{i}][{i}]" for i in n)
    scaled = "[[x / t FOR x IN row] FOR row IN m]"
    along = " + ".join(f"c[{i}][{j}] * m[{j}][{i}]" for i in n for j in n)
    rest = "[" + ", ".join("[" + ", ".join(f"c[{i}][{j}] - l * m[{i}][{j}]" for j in n) + "]" for i in n) + "]"

    def power(name: str, start: str) -> str:
        return f"""{name} AS (
          SELECT 0 AS step, m FROM ({start}) UNION ALL
          SELECT step + 1, {scaled} FROM (SELECT step, m, {trace} AS t FROM (SELECT step, {product} AS m FROM {name} WHERE step < 60)))"""

    return f"""c AS (SELECT [{corr}] AS c FROM {table} WHERE {' AND '.join(f'{x} IS NOT NULL' for x in columns)}), {power('p1', 'SELECT c AS m FROM c')},
        first AS (SELECT c, m, {along} AS l FROM c, p1 WHERE step = 60), {power('p2', f'SELECT {rest} AS m FROM first')},
        second AS (SELECT l, {along} AS l2 FROM (SELECT c, l FROM first), (SELECT m FROM p2 WHERE step = 60))"""


ORACLES: dict[str, str] = {
    "clean_standardise": f"WITH {STD} SELECT * EXCLUDE (img_paths) FROM std",
    "clean_text": f"""WITH {RAW} SELECT ingest_seq, left(nullif(trim(name), ''), 8) AS title_8,
        {_title_case("nullif(trim(name), '')")} AS title_cased,
        CASE WHEN format = 'Audio CD' THEN 'Audio CD' || upper(category[1]) || lower(category[2:])
             ELSE format || ' ' || upper(category[1]) || lower(category[2:]) END AS camel_label,
        format || ' ' || category AS dash_label FROM raw""",
    "impute_all": f"WITH {FILLED} SELECT ingest_seq, {r('price', 4)} AS price, old_price, rating, author, format FROM filled",
    "drop_invalid": f"WITH {STD} SELECT ingest_seq, isbn, price FROM std WHERE price IS NOT NULL AND isbn IS NOT NULL",
    "path_remap": f"""WITH {RAW} SELECT ingest_seq, replace(img_paths, 'dataset/', 'book-covers/') AS local_path,
        CASE WHEN ingest_seq % 2 = 0 THEN replace(img_paths, 'dataset/', '/covers/') END AS cover_url FROM raw""",
    "price_features": f"WITH {FEAT} SELECT ingest_seq, discount_amount, discount_pct, price_gbp, value_score, is_bestseller FROM feat",
    "text_features": f"""WITH w AS (SELECT doc_id, lang, text, length(text) AS n,
          len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words FROM documents)
        SELECT doc_id, CAST(n AS INTEGER) AS title_length, CAST(words AS INTEGER) AS word_count,
          {r('coalesce(CAST(n AS DOUBLE) / nullif(words, 0), 0)', 4)} AS chars_per_word,
          CAST(regexp_matches(text, '[:-]') AS INTEGER) AS has_subtitle, CAST(lower(lang) = 'en' AS INTEGER) AS is_english FROM w""",
    "tier_counts": f"""WITH {FEAT} SELECT 'price_tier' AS tier_column, price_tier AS tier, count(*) AS rows FROM feat GROUP BY ALL
        UNION ALL SELECT 'discount_tier', discount_tier, count(*) FROM feat GROUP BY ALL""",
    "key_validity": f"""WITH {STD} SELECT count(*) AS total, count(*) FILTER (regexp_full_match(isbn, '[0-9]{{13}}')) AS valid_13,
        count(*) FILTER (regexp_full_match(isbn, '[0-9]{{10,13}}')) AS valid_10_13 FROM std""",
    "dedup_first": f"""WITH {RAW} SELECT coalesce(trim(isbn), '') AS isbn, min(ingest_seq) AS ingest_seq FROM raw GROUP BY 1""",
    "dedup_keep_blank": f"""WITH {RAW} SELECT isbn, min(ingest_seq) AS ingest_seq FROM raw WHERE isbn IS NOT NULL GROUP BY 1
        UNION ALL SELECT '', ingest_seq FROM raw WHERE isbn IS NULL""",
    "dedup_two_stage": """WITH once AS (
          SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_orderkey, l_partkey,
            l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM once WHERE l_partkey % 10 = 0
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
          SELECT * FROM once WHERE l_partkey % 10 <> 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_orderkey,
            l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1)""",
    "append_records": f"""WITH {FEAT}, form AS (
          SELECT CASE WHEN p_partkey % 40 = 7 THEN p_name ELSE 'Untitled' END AS title,
            CASE WHEN p_partkey % 60 = 7 THEN 10.0 ELSE p_size END::DOUBLE AS price,
            CASE WHEN p_partkey % 100 = 7 THEN 1.5 WHEN p_size > 40 THEN 99.5 END::DOUBLE AS asked FROM part
        ), added AS (
          SELECT 'Added' AS category, title, price, greatest(coalesce(asked, price), price) AS old_price,
            {r('4.8 / greatest(price, 0.01)', 4)} AS value_score, true AS is_bestseller FROM form
        ), everything AS (
          SELECT * FROM added UNION ALL SELECT category, title, price, old_price, value_score, is_bestseller FROM feat)
        SELECT category, count(*) AS rows, {xsum('price')} AS sum_price, {xsum('old_price')} AS sum_old_price,
          {xsum('value_score')} AS sum_value_score, count(*) FILTER (title = 'Untitled') AS untitled,
          count(*) FILTER (is_bestseller) AS bestsellers FROM everything GROUP BY category""",
    "etl_fact": f"""WITH {FEAT} SELECT isbn, title, author, format, category, {r('price', 4)} AS price, old_price, rating, discount_amount,
        discount_pct, price_gbp, value_score, CAST(is_bestseller AS INTEGER) AS is_bestseller, price_tier FROM feat""",
    "sample_rows": f"""WITH {STD} SELECT CAST(ingest_seq AS VARCHAR) AS ingest_seq,
        coalesce(CASE WHEN length(title) > 10 THEN left(title, 7) || '...' ELSE title END, 'N/A') AS title,
        coalesce(author, 'N/A') AS author, coalesce(format, 'N/A') AS format
        FROM std ORDER BY md5(CAST(std.ingest_seq AS VARCHAR)), std.ingest_seq LIMIT 12""",
    "category_stats": f"""WITH {FEAT} SELECT category, count(isbn) AS total_books, {r(xmean('price'), 2)} AS avg_price_usd,
        {r(xmean('rating'), 2)} AS avg_rating, {r(xmean('discount_pct'), 1)} AS avg_discount,
        count(*) FILTER (is_bestseller) AS bestsellers FROM feat GROUP BY category""",
    "top_entities": f"""WITH {FEAT} SELECT author, count(isbn) AS books, {r(xmean('rating'), 2)} AS avg_rating, {r(xmean('price'), 2)} AS avg_price
        FROM feat WHERE author <> 'Unknown' GROUP BY author ORDER BY books DESC, author LIMIT 10""",
    "category_insights": f"""WITH {FEAT}, c AS (SELECT category, {xmean('discount_pct')} AS d,
          CAST(count(*) FILTER (is_bestseller) AS DOUBLE) AS b FROM feat GROUP BY category)
        (SELECT 'top_discounted' AS insight, category, {r('d', 1)} AS value FROM c ORDER BY d DESC, category LIMIT 4)
        UNION ALL (SELECT 'top_bestsellers', category, b FROM c ORDER BY b DESC, category LIMIT 4)""",
    "value_counts": _value_counts(),
    "entity_relative": f"""WITH e AS (SELECT l_suppkey, count(*) AS entity_count, avg(l_quantity) AS a FROM lineitem GROUP BY 1),
        g AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS m FROM lineitem GROUP BY 1)
        SELECT l_orderkey, l_linenumber, l_partkey, l.l_suppkey, entity_count, {r('a', 4)} AS entity_avg,
          {r('l_extendedprice - m', 3)} AS diff_from_group_median
        FROM lineitem l JOIN e ON l.l_suppkey = e.l_suppkey JOIN g ON l.l_returnflag = g.l_returnflag""",
    "null_profile": f"WITH {RAW} {_nulls({c: c for c in RAW_COLUMNS})}",
    "null_totals": f"""WITH {RAW} SELECT count(*) AS total_rows, 10 AS total_cols, CAST(sum({RAW_NULLS}) AS BIGINT) AS total_missing,
        {r(f'sum({RAW_NULLS}) * 100.0 / (count(*) * 10)', 2)} AS missing_pct FROM raw""",
    "dup_profile": """SELECT 'row' AS scope, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows
        UNION ALL SELECT 'key', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))""",
    "numeric_profile": union(
        [_profile(t, c) for t, c in (("part", "p_size"), ("part", "p_retailprice"), ("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"))]
    ),
    "summary_points": f"SELECT column_name, min, q25, median, mean, q75, q90, max FROM ({_profile('orders', 'o_totalprice')})",
    "describe_table": f"SELECT column_name, n, mean, std, min, q25, median, q75, max FROM ({_profile('customer', 'c_acctbal')})",
    "distinct_counts": union([f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lineitem" for c in ("l_returnflag", "l_partkey", "l_suppkey")]),
    "histogram": _histogram("l_extendedprice", "lineitem", 20),
    "histogram_log": _histogram("log10(l_extendedprice)", "lineitem WHERE l_extendedprice > 0", 30),
    "corr_matrix": _corr(),
    "iqr_outliers": _outliers(),
    "iqr_cap": _cap(),
    "minmax_scale": "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(r(f"({c} - lo_{c}) / (hi_{c} - lo_{c})", 4) + f" AS scaled_{c}" for c in LINE_MEASURES)
    + " FROM lineitem, (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LINE_MEASURES)
    + " FROM lineitem)",
    "zscore_scale": "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(r(f"({c} - m_{c}) / s_{c}", 3) + f" AS z_{c}" for c in LINE_MEASURES)
    + " FROM lineitem, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LINE_MEASURES)
    + " FROM lineitem)",
    "pca_points": f"""WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS r, avg(l_quantity) AS mq, avg(l_extendedprice) AS mp,
          stddev_pop(l_quantity) AS sq, stddev_pop(l_extendedprice) AS sp FROM lineitem),
        z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, r, (l_quantity - mq) / sq AS a, (l_extendedprice - mp) / sp AS b FROM lineitem, c)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
          {r('(a + CASE WHEN r >= 0 THEN b ELSE -b END) / sqrt(2)', 3)} AS pc1, {r('(a - CASE WHEN r >= 0 THEN b ELSE -b END) / sqrt(2)', 3)} AS pc2 FROM z""",
    "pca_total": f"""WITH RECURSIVE {FEAT}, {_two_components('feat', PCA_FEATURES)}
        SELECT {r(f"{r(f'l * 100 / {len(PCA_FEATURES)}', 1)} + {r(f'l2 * 100 / {len(PCA_FEATURES)}', 1)}", 1)} AS total_variance_pct FROM second""",
    "pca_two_feature": f"""WITH c AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS a FROM lineitem)
        SELECT CAST(1 AS INTEGER) AS component, {r('(1 + a) / 2 * 100', 1)} AS variance_pct FROM c
        UNION ALL SELECT 2, {r('(1 - a) / 2 * 100', 1)} FROM c""",
    "before_after": f"""WITH {FEAT}, b AS (SELECT count(*) AS rows, 10 AS cols, sum({RAW_NULLS}) AS nulls,
          count(*) - count(DISTINCT coalesce(isbn, '?')) AS dups, count(*) FILTER (price IS NULL) AS np,
          count(*) FILTER (book_depository_stars IS NULL) AS nr FROM raw),
        a AS (SELECT count(*) AS rows, 20 AS cols,
          count(*) FILTER (title IS NULL) + count(*) FILTER (old_price IS NULL) + count(*) FILTER (discount_amount IS NULL) AS nulls,
          count(*) - count(DISTINCT isbn) AS dups, count(*) FILTER (price IS NULL) AS np, count(*) FILTER (rating IS NULL) AS nr FROM feat)
        """
    + union(
        [
            f"SELECT '{name}' AS attribute, CAST({expr.format('b')} AS DOUBLE) AS before, CAST({expr.format('a')} AS DOUBLE) AS after FROM a, b"
            for name, expr in {
                "rows": "{0}.rows",
                "columns": "{0}.cols",
                "null_cells": "{0}.nulls",
                "null_pct": r("{0}.nulls * 100.0 / ({0}.rows * {0}.cols)", 2),
                "duplicate_keys": "{0}.dups",
                "nulls_price": "{0}.np",
                "nulls_rating": "{0}.nr",
            }.items()
        ]
    ),
    "stage_funnel": f"""WITH {DEDUP} SELECT 'raw' AS stage, count(*) AS rows, CAST(10 AS INTEGER) AS cols FROM raw
        UNION ALL SELECT 'standardised', count(*), 10 FROM std
        UNION ALL SELECT 'deduplicated', count(*), 10 FROM dedup UNION ALL SELECT 'featured', count(*), 20 FROM dedup""",
    "transform_summary": f"""WITH {FEAT}, s AS (SELECT count(*) AS n, sum("""
    + " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in ("isbn", "title", "author", "format", "category", "price", "old_price", "rating", "img_paths"))
    + """) AS nulls FROM std), a AS (SELECT count(*) FILTER (title IS NULL) + count(*) FILTER (old_price IS NULL) AS nulls FROM filled),
        o AS (SELECT count(*) AS n, count(*) FILTER (is_bestseller) AS b FROM feat)
        SELECT s.n AS input_rows, o.n AS output_rows, s.n - o.n AS dupes_removed, CAST(s.nulls - a.nulls AS BIGINT) AS nulls_filled, b AS flagged FROM s, a, o""",
    "extract_summary": f"WITH {RAW} "
    + union(
        [f"SELECT 'nulls_{c}' AS measure, count(*) FILTER ({c} IS NULL) AS value FROM raw" for c in ("price", "book_depository_stars", "old_price", "author", "isbn")]
        + [
            "SELECT 'rows', count(*) FROM raw",
            "SELECT 'columns', CAST(10 AS BIGINT)",
            f"SELECT 'null_cells', CAST(sum({RAW_NULLS}) AS BIGINT) FROM raw",
            "SELECT 'duplicate_keys', count(*) - count(DISTINCT coalesce(isbn, '?')) FROM raw",
        ]
    ),
    "api_features": f"WITH {REC_FACT} SELECT * FROM fact",
    "popularity_topk": f"""WITH {REC_FACT} SELECT ol_key, title, author, avg_rating, rating_count, popularity_score FROM fact
        ORDER BY popularity_score DESC, ol_key LIMIT 5""",
    "source_summary": f"""WITH {REC_FACT} SELECT api_source, count(*) AS total_books, {r('avg(avg_rating)', 2)} AS avg_rating,
        {r('avg(pages)', 0)} AS avg_pages, CAST(sum(is_highly_rated) AS BIGINT) AS highly_rated_count,
        CAST(sum(has_isbn) AS BIGINT) AS books_with_isbn FROM fact GROUP BY api_source""",
    "quality_counts": f"""WITH {REC_FACT} SELECT count(*) FILTER (has_isbn = 1) AS with_isbn, count(*) FILTER (has_isbn = 0) AS without_isbn,
        count(*) FILTER (is_highly_rated = 1) AS highly_rated, count(*) FILTER (avg_rating = 0) AS zero_rating,
        count(*) FILTER (publisher <> 'Unknown Publisher') AS with_publisher FROM fact""",
    "page_tier_counts": f"WITH {REC_FACT} "
    + union([f"SELECT '{c}' AS tier_column, {c} AS tier, count(*) AS rows FROM fact GROUP BY ALL" for c in ("page_tier", "rating_category", "publish_decade")]),
    "record_pages_ingest": f"""WITH {REC_FLAT} SELECT api_source AS source, count(*) AS records, 'SUCCESS' AS status FROM flat GROUP BY 1
        UNION ALL SELECT 'history', 0, 'FAILED'""",
    "record_pages_docs": f"WITH {REC_FLAT} SELECT ol_key, api_source, author, isbn, pages, avg_rating FROM flat",
    # Pages are read source by source.
    "record_pipeline": f"""WITH {REC_FACT.replace("ORDER BY ingest_seq", "ORDER BY api_source, ingest_seq")}, n AS (SELECT (SELECT count(*) FROM flat) AS x, (SELECT count(*) FROM recdedup) AS t)
        SELECT 'run' AS part, s AS name, 'SUCCESS' AS detail, x::DOUBLE AS a, t::DOUBLE AS b, t::DOUBLE AS c FROM n, (SELECT 'full' AS s UNION ALL SELECT 'incremental')
        UNION ALL SELECT 'fact', ol_key, page_tier, publish_year, avg_rating, popularity_score FROM fact""",
    "gate_checks": f"""WITH {STD}, n AS (SELECT count(*) AS rows,
          count(*) FILTER (isbn IS NULL) + count(*) FILTER (title IS NULL) + count(*) FILTER (price IS NULL) + count(*) FILTER (rating IS NULL) AS nulls,
          count(*) FILTER (rating < 0 OR rating > 5) AS rr, count(*) FILTER (price < 1 OR price > 45) AS pr,
          count(*) - count(DISTINCT coalesce(isbn, '?')) AS dups FROM std)
        SELECT 'Row count >= 1' AS "check", CASE WHEN rows >= 1 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(0 AS BIGINT) AS failing FROM n
        UNION ALL SELECT 'Critical columns null rate <= 0.05', CASE WHEN nulls / (rows * 4.0) <= 0.05 THEN 'PASS' ELSE 'FAIL' END, nulls FROM n
        UNION ALL SELECT 'Rating range [0 - 5]', CASE WHEN rr = 0 THEN 'PASS' ELSE 'FAIL' END, rr FROM n
        UNION ALL SELECT 'price range [1 - 45]', CASE WHEN pr = 0 THEN 'PASS' ELSE 'FAIL' END, pr FROM n
        UNION ALL SELECT 'Primary key (isbn) uniqueness', CASE WHEN dups = 0 THEN 'PASS' ELSE 'FAIL' END, dups FROM n""",
    "gate_checks_clean": f"""WITH {REC_FACT}, n AS (SELECT count(*) AS rows, count(*) FILTER (avg_rating < 0 OR avg_rating > 5) AS rr,
          count(*) FILTER (publish_year < 1000 OR publish_year > 2030) AS yr, count(*) - count(DISTINCT ol_key) AS dups FROM fact)
        SELECT 'Row count >= 1' AS "check", CASE WHEN rows >= 1 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(0 AS BIGINT) AS failing FROM n
        UNION ALL SELECT 'Critical columns null rate <= 0.05', 'PASS', 0 FROM n
        UNION ALL SELECT 'Rating range [0 - 5]', CASE WHEN rr = 0 THEN 'PASS' ELSE 'FAIL' END, rr FROM n
        UNION ALL SELECT 'publish_year range [1000 - 2030]', CASE WHEN yr = 0 THEN 'PASS' ELSE 'FAIL' END, yr FROM n
        UNION ALL SELECT 'Primary key (ol_key) uniqueness', CASE WHEN dups = 0 THEN 'PASS' ELSE 'FAIL' END, dups FROM n""",
    "validate_report": f"WITH {_report()} SELECT * FROM report",
    "validate_totals": f"""WITH {_report()}, t AS (SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS passed,
          count(*) FILTER (status = 'WARN') AS warned, count(*) FILTER (status = 'FAIL') AS failed FROM report)
        SELECT *, {r('passed * 100.0 / total', 1)} AS pass_rate,
          CASE WHEN {r('passed * 100.0 / total', 1)} >= 90 THEN 'PASS' ELSE 'FAIL' END AS gate FROM t""",
    "validate_groups": f"""WITH {_report()} SELECT "check", count(*) FILTER (status = 'PASS') AS passed, count(*) AS total FROM report GROUP BY 1""",
    "quarantine_split": f"WITH {STD} SELECT 'curated' AS route, 'ok' AS reason, count(*) AS rows FROM std WHERE NOT ({ANY_RULE}) HAVING count(*) > 0 UNION ALL "
    + union([f"SELECT 'quarantine', '{name}', count(*) FROM std WHERE {c} HAVING count(*) > 0" for name, c in RULES.items()]),
    "quarantine_routes": f"""WITH {STD} SELECT 'warehouse' AS table_name, count(*) AS rows FROM std WHERE NOT ({ANY_RULE})
        UNION ALL SELECT 'audit', count(*) FROM std WHERE NOT ({ANY_RULE}) AND (rating IS NULL OR title IS NULL)
        UNION ALL SELECT 'quarantine', count(*) FROM std WHERE {ANY_RULE}""",
    "quarantine_reprocess": f"""WITH {STD}, bad AS (SELECT ingest_seq, isbn, coalesce(price, 9.99) AS price FROM std WHERE {ANY_RULE})
        SELECT CASE WHEN {ANY_RULE} THEN 'quarantine' ELSE 'fixed' END AS route, ingest_seq, isbn, price FROM bad""",
    "load_verify": f"""WITH {UPSERTED} SELECT 'row_count' AS "check", 'PASS' AS status,
          concat((SELECT count(*) FROM merged), '/', (SELECT count(*) FROM new)) AS detail
        UNION ALL SELECT 'required_columns', 'FAIL', 'o_comment'""",
    "cdc_summary": f"""WITH {DIFF} SELECT count(*) FILTER (op = 'INSERT') AS inserted, count(*) FILTER (op = 'UPDATE') AS updated,
        count(*) FILTER (op = 'DELETE') AS deleted, count(*) FILTER (op = 'UNCHANGED') AS unchanged FROM diff""",
    "cdc_key_sets": f"""WITH {DIFF} SELECT 'inserted' AS key_set, count(*) AS keys FROM diff WHERE op = 'INSERT'
        UNION ALL SELECT 'deleted', count(*) FROM diff WHERE op = 'DELETE'
        UNION ALL SELECT 'common', count(*) FROM diff WHERE op IN ('UPDATE', 'UNCHANGED')""",
    "cdc_samples": f"""WITH {DIFF}
        (SELECT 'inserted' AS change, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
          CASE WHEN b2 = 'F' THEN 'N/A' ELSE b2 END AS o_orderstatus, b3 AS o_totalprice
          FROM diff WHERE op = 'INSERT' ORDER BY diff.o_orderkey LIMIT 5)
        UNION ALL (SELECT 'deleted', CAST(o_orderkey AS VARCHAR), a2, a3 FROM diff WHERE op = 'DELETE' ORDER BY diff.o_orderkey LIMIT 5)""",
    "cdc_feed": f"WITH {DIFF} SELECT o_orderkey, op FROM diff WHERE op <> 'UNCHANGED'",
    "cdc_column_audit": f"WITH {DIFF} "
    + union(
        [
            f"SELECT o_orderkey, op AS action, '{c}' AS column_changed, a{i} AS old_value, b{i} AS new_value FROM diff WHERE a{i} IS DISTINCT FROM b{i}"
            for i, c in enumerate(("o_custkey", "o_orderstatus", "o_totalprice"), 1)
        ]
    ),
    "cdc_apply": f"WITH {SNAPSHOTS} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM new",
    "upsert_result": f"WITH {UPSERTED} SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM merged",
    "upsert_metrics": f"""WITH {DIFF} SELECT count(*) FILTER (op IN ('UPDATE', 'UNCHANGED')) AS matched, count(*) FILTER (op = 'INSERT') AS inserted,
        count(*) FILTER (op = 'UPDATE') AS modified, count(*) FILTER (op = 'UNCHANGED') AS unchanged, count(*) AS total_after FROM diff""",
    "incremental_load": f"WITH {UPSERTED} SELECT o_orderkey, o_totalprice FROM merged",
    "bucket_evolution": f"""WITH {SNAPSHOTS} SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus FROM old
        UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)""",
    "bucket_atomic": f"""WITH {UPSERTED} SELECT 'failed' AS state, count(*) AS rows, {xsum('o_totalprice')} AS total FROM old
        UNION ALL SELECT 'repeated', count(*), {xsum('o_totalprice')} FROM merged""",
    "bucket_upsert": f"WITH {UPSERTED} SELECT o_orderkey, o_totalprice FROM merged",
    "change_audit": f"WITH {DIFF} "
    + union(
        [
            f"SELECT CAST(o_orderkey AS VARCHAR) AS key_id, op AS action, '{c}' AS column_changed, a{i} AS old_value, b{i} AS new_value "
            f"FROM diff WHERE op IN ('INSERT', 'UPDATE') AND a{i} IS DISTINCT FROM b{i}"
            for i, c in ((1, "o_custkey"), (3, "o_totalprice"))
        ]
    ),
    "partition_overwrite": f"""WITH {SNAPSHOTS}, kept AS (SELECT * FROM old WHERE year(o_orderdate) < 1999 UNION ALL SELECT * FROM new WHERE year(o_orderdate) >= 1999)
        SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS rows, {xsum('o_totalprice')} AS total FROM kept GROUP BY 1""",
    "csv_roundtrip": f"""WITH {STD} SELECT category, '$' AS currency, count(*) AS rows, count(isbn) AS isbns, count(title) AS titles,
        {xsum('price')} AS sum_price, {xsum('old_price')} AS sum_old_price FROM std GROUP BY category""",
    "zone_evolution": f"""WITH {SNAPSHOTS} SELECT 'r1' AS run_id, 'old' AS source, count(*) AS rows, CAST(0 AS BIGINT) AS with_status FROM old
        UNION ALL SELECT 'r2', 'new', count(*), count(o_orderstatus) FROM new""",
    "checksum_dedup": f"WITH {DIFF} SELECT n.o_orderkey, n.o_totalprice FROM new n JOIN diff USING (o_orderkey) WHERE op IN ('INSERT', 'UPDATE')",
    "checksum_index": f"""WITH {SNAPSHOTS}, o AS (SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM old),
        n AS (SELECT * FROM o UNION SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM new)
        SELECT 'first' AS state, count(*) AS rows, {xsum('o_totalprice')} AS total FROM o
        UNION ALL SELECT s, count(*), {xsum('o_totalprice')} FROM n, (SELECT unnest(['batch', 'again']) AS s) GROUP BY s""",
    "dataset_checksum": """SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)), 1, 12) AS BIGINT)) AS VARCHAR) AS checksum FROM orders""",
    "table_status": union([f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("orders", "lineitem", "part")]),
    "missing_partitions": """SELECT CAST(d AS DATE) AS missing_date FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS d)
        WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE dayofweek(ts) NOT IN (0, 6))""",
    "backfill_days": "SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1",
    "backfill_pruned": f"SELECT CAST(ts AS DATE) AS day, count(*) AS rows, {xsum('value')} AS total FROM events GROUP BY 1",
    "bucketed_fact": f"""SELECT l_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS time_key, count(*) AS lines,
        {xsum('l_extendedprice')} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "bucketed_diff": f"WITH {DIFF} SELECT o_orderkey, op FROM diff",
    "source_status": """SELECT s AS source, count(event_id) AS records, CASE WHEN count(event_id) > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
        FROM (SELECT unnest(['view', 'click', 'signup', 'purchase', 'error', 'refund']) AS s) LEFT JOIN events ON event_type = s GROUP BY s""",
    "events_json_props": f"""SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS rows, {r('avg(value)', 4)} AS avg_value FROM events GROUP BY 1""",
    "dim_category": """SELECT row_number() OVER (ORDER BY n) AS category_key, n AS category_name, split_part(n, '-', 1) AS parent_category
        FROM (SELECT DISTINCT p_type || '-' || p_brand AS n FROM part)""",
    "dim_first_seen": f"""WITH {RAW} SELECT row_number() OVER (ORDER BY s, author) AS author_key, author AS author_name
        FROM (SELECT author, min(ingest_seq) AS s FROM raw WHERE author IS NOT NULL GROUP BY author)""",
    "dim_publisher": """SELECT row_number() OVER (ORDER BY n) AS publisher_key, n AS publisher_name, 'UK' AS region
        FROM (SELECT DISTINCT p_type || ' House' AS n FROM part)""",
    "dim_time": """SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS time_key, CAST(year(m) AS INTEGER) AS year, 'Q' || quarter(m) AS quarter, CAST(month(m) AS INTEGER) AS month
        FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)""",
    "dim_upsert": """WITH b AS (SELECT DISTINCT p_brand AS n FROM part), e AS (SELECT row_number() OVER (ORDER BY n) AS k, n FROM b WHERE n LIKE '%1%')
        SELECT k AS brand_key, n AS brand_name, false AS is_new FROM e
        UNION ALL SELECT row_number() OVER (ORDER BY n) + (SELECT max(k) FROM e), n, true FROM b WHERE n NOT LIKE '%1%'""",
    "fact_sales": f"""WITH c AS (SELECT n, row_number() OVER (ORDER BY n) AS category_key FROM (SELECT DISTINCT p_type AS n FROM part)),
        b AS (SELECT n, row_number() OVER (ORDER BY n) AS publisher_key FROM (SELECT DISTINCT p_brand AS n FROM part WHERE p_brand <> 'Brand#7'))
        SELECT l_orderkey, l_linenumber, category_key, coalesce(publisher_key, -1) AS publisher_key,
          CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS time_key, count(*) AS rows,
          {xsum('l_quantity')} AS quantity, {xsum('l_extendedprice')} AS price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN c ON p_type = c.n LEFT JOIN b ON p_brand = b.n
        GROUP BY ALL""",
    "nf3_books": f"""WITH {FEAT}, au AS (SELECT n, row_number() OVER (ORDER BY n) AS id FROM (SELECT DISTINCT author AS n FROM feat WHERE author <> 'Unknown')),
        ca AS (SELECT n, row_number() OVER (ORDER BY n) AS id, row_number() OVER (ORDER BY n || ' Publishing') AS pid FROM (SELECT DISTINCT category AS n FROM feat))
        SELECT isbn, left(title, 200) AS title, coalesce(au.id, -1) AS author_id, ca.pid AS publisher_id, ca.id AS category_id,
          {r('price', 4)} AS price, rating FROM feat LEFT JOIN au ON author = au.n JOIN ca ON category = ca.n WHERE title IS NOT NULL""",
    "star_catalog": STAR,
    "warehouse_publish": STAR,
    "star_complete": f"""WITH {FEAT}, f AS (SELECT count(*) AS n FROM feat WHERE isbn IS NOT NULL AND category IS NOT NULL AND price IS NOT NULL)
        SELECT 'fact' AS table_name, n AS rows FROM f UNION ALL SELECT 'joined', n FROM f UNION ALL SELECT 'orphans', CAST(0 AS BIGINT)""",
    "gate_two_ratings": f"""WITH {STD} SELECT 'rating range [0 - 5]' AS "check", CASE WHEN count(*) FILTER (ingest_seq % 50 = 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
          count(*) FILTER (ingest_seq % 50 = 0) AS failing FROM std UNION ALL SELECT 'avg_rating range [0 - 5]', 'PASS', CAST(0 AS BIGINT)""",
    "snowflake_rollup": f"WITH {SALES} SELECT r_name AS region_name, p_type AS genre_name, count(*) AS rows, {xsum('l_extendedprice')} AS revenue FROM sales GROUP BY ALL",
    "fk_integrity": """SELECT 'part' AS dimension, CAST(0 AS BIGINT) AS orphan_rows UNION ALL SELECT 'supplier', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
        UNION ALL SELECT 'orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'reduced_part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)""",
    "olap_slice": f"WITH {SALES} SELECT p_type, l_returnflag, {SALES_MEASURES} FROM sales WHERE p_type = 'PROMO' GROUP BY ALL",
    "olap_dice": f"""WITH {SALES} SELECT p_type, l_returnflag, r_name, {SALES_MEASURES} FROM sales
        WHERE p_type IN ('PROMO', 'ECONOMY', 'SMALL') AND l_extendedprice BETWEEN 10000 AND 50000 GROUP BY ALL""",
    "olap_rollup": f"""WITH {SALES} SELECT p_type, count(*) AS row_count, {xsum('l_extendedprice')} AS total_revenue, {r(xmean('l_quantity'), 2)} AS avg_l_quantity,
        CAST(sum(CAST(l_quantity >= 45 AS INTEGER)) AS BIGINT) AS flagged FROM sales GROUP BY p_type ORDER BY total_revenue DESC, p_type LIMIT 15""",
    "olap_rollup_total": f"""WITH {SALES} SELECT p_type, p_brand, CAST(grouping_id(p_type, p_brand) AS BIGINT) AS grouping_id, {CUBE_MEASURES}
        FROM sales GROUP BY ROLLUP (p_type, p_brand)""",
    "olap_drilldown": f"""WITH {SALES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, r_name, l_returnflag, l_extendedprice, l_quantity
        FROM sales WHERE p_type = 'PROMO' ORDER BY l_extendedprice DESC, l_quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 12""",
    "cube_full": f"""WITH {SALES} SELECT p_type, l_returnflag, r_name, CAST(grouping_id(p_type, l_returnflag, r_name) AS BIGINT) AS grouping_id, {CUBE_MEASURES}
        FROM sales GROUP BY CUBE (p_type, l_returnflag, r_name)""",
    "cube_merge": f"""WITH {SALES} SELECT p_type, l_returnflag, r_name, CAST(grouping_id(p_type, l_returnflag, r_name) AS BIGINT) AS grouping_id, {CUBE_MEASURES}
        FROM sales GROUP BY CUBE (p_type, l_returnflag, r_name)""",
    "cube_slice_all": f"""WITH {SALES} SELECT CAST(NULL AS VARCHAR) AS p_type, l_returnflag, CAST(NULL AS VARCHAR) AS r_name, CAST(5 AS BIGINT) AS grouping_id, {CUBE_MEASURES}
        FROM sales WHERE l_returnflag = 'R' GROUP BY l_returnflag""",
    "cube_topn": f"""WITH {SALES}, b AS (SELECT p_brand FROM sales GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6),
        f AS (SELECT l_returnflag, l_linestatus FROM sales GROUP BY ALL ORDER BY count(*) DESC, 1, 2 LIMIT 4)
        SELECT p_brand, l_returnflag, l_linestatus, {SALES_MEASURES} FROM sales SEMI JOIN b USING (p_brand) SEMI JOIN f USING (l_returnflag, l_linestatus) GROUP BY ALL""",
    "cube_parquet": f"WITH {SALES} SELECT l_returnflag, count(*) AS row_count, {xsum('l_extendedprice')} AS sum_l_extendedprice FROM sales GROUP BY 1",
    "olap_custom_sql": f"""WITH {SALES} SELECT p_brand, count(*) AS row_count, max(l_extendedprice) AS top_price FROM sales
        WHERE r_name = 'ASIA' AND l_quantity >= 30 GROUP BY 1""",
    "fx_convert": f"""SELECT 'GBP' AS currency, CAST(0.81 AS DOUBLE) AS rate, {xsum(r('p_retailprice * CAST(0.81 AS DOUBLE)', 2))} AS converted FROM part
        UNION ALL SELECT 'EUR', CAST(0.92 AS DOUBLE), {xsum(r('p_retailprice * CAST(0.92 AS DOUBLE)', 2))} FROM part""",
    "enrich_prefix_lookup": """WITH m AS (SELECT * FROM (VALUES (0, 'Pan Macmillan', 'UK'), (1, 'Penguin Books', 'UK'), (2, 'Vintage Publishing', 'UK'),
          (3, 'Robinson', 'UK'), (4, 'Rider', 'UK'), (5, 'Pan Books', 'UK'), (6, 'Short Books Ltd', 'UK'), (7, 'Penguin Life', 'UK'),
          (8, 'Unknown Publisher', 'Global'), (9, 'Independent Publisher', 'Unknown'), (10, 'Independent Publisher', 'Unknown'),
          (11, 'Independent Publisher', 'Unknown')) AS t(slot, publisher, publisher_region))
        SELECT publisher, publisher_region, count(*) AS rows FROM part JOIN m ON p_partkey % 12 = slot GROUP BY ALL""",
    "stream_ingest": "SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "stream_dedup": f"SELECT count(*) AS rows, {xsum('value')} AS total FROM events",
    "stream_throughput": f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
        FROM events GROUP BY ALL""",
    "stream_throughput_sliding": f"""WITH w AS (SELECT date_trunc('hour', ts) AS s, event_type FROM events
          UNION ALL SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR, event_type FROM events)
        SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM w GROUP BY ALL""",
    "stream_operations": f"SELECT event_type, count(*) AS rows, {xsum('value')} AS total FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY 1",
    "stream_last_value": """SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_state_last": """SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_resume": "SELECT event_id, value, ts < TIMESTAMP '2024-01-16' AS early FROM events",
    "stream_dead_letters": """SELECT 'loaded' AS route, event_id, user_id, value FROM events WHERE event_id % 13 <> 0
        UNION ALL SELECT 'dead_letter', NULL, NULL, NULL FROM events WHERE event_id % 13 = 0""",
    "run_metrics": f"""WITH runs AS (SELECT event_id % 7 <> 0 AS ok, event_id % 5000 AS ms, event_id % 97 AS loaded FROM events)
        SELECT count(*) AS runs, {r('count(*) FILTER (ok) * 100.0 / count(*)', 2)} AS success_rate,
          {r('count(*) FILTER (NOT ok) * 100.0 / count(*)', 2)} AS error_rate, {r('avg(ms)', 1)} AS avg_latency_ms,
          {r('CAST(sum(loaded) AS DOUBLE) / (sum(ms) / 60000.0)', 1)} AS records_per_minute FROM runs""",
    "latest_runs": """SELECT CAST(event_id AS VARCHAR) AS run_id, CASE WHEN event_id % 7 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
          event_id % 5000 AS total_ms FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 12""",
    "run_freshness": """SELECT CAST(floor(epoch(TIMESTAMP '2024-01-31 00:00:00')) - floor(epoch(max(ts))) AS BIGINT) AS freshness_seconds FROM events""",
    "catalog_report": f"WITH {_report(CATALOG_COLUMNS, CATALOG_NUMBERS)} SELECT * FROM report",
    "failed_run_log": f"""WITH {FEAT}, n AS (SELECT (SELECT count(*) FROM raw) AS e, (SELECT count(*) FROM feat) AS l)
        SELECT 'FAILED' AS status, 'FULL' AS load_strategy, e AS extracted_records, NULL AS loaded_records FROM n
        UNION ALL SELECT 'SUCCESS', 'FULL', e, l FROM n""",
    "catalog_pipeline": f"""WITH {FEAT}
        SELECT 'etl_fact' AS table_name, price_tier AS member, count(*) AS rows, {xsum('price')} AS total FROM feat GROUP BY ALL
        UNION ALL SELECT 'books', category, count(*), {xsum('price')} FROM feat WHERE title IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'star', category || '/' || format, count(*), {r(xmean('price'), 2)} FROM feat GROUP BY ALL
        UNION ALL SELECT 'etl_log', 'SUCCESS', 1, count(*)::DOUBLE FROM feat""",
}
