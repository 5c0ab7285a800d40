"""From wide submissions to canonical points."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.catalog import inputs
from fieldledger.catalog.registry import query, table
from fieldledger.functions.numbers import DECIMAL_PATTERN, SPECIAL_PATTERN, is_numeric, value_to_string
from fieldledger.functions.periods import (
    distinct_periods,
    in_periods,
    is_month,
    iso_date,
    months_between,
    period_of,
    period_start,
    previous_months,
    select_periods,
)
from fieldledger.functions.text import clean_text
from fieldledger.operators import canonical, choices, columns, derive, quality, reshape, standard
from fieldledger.plans import transform
from fieldledger.plans.ingest import select_submissions
from fieldledger.settings import Derivations


@query(f"SELECT {inputs.DERIVED_SQL} FROM ({inputs.SUBMISSIONS_SQL})")
def derive_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums that a null makes null, halves and yes/no indicators, in one projection."""
    return derive.derive(inputs.submissions(spark, sf_dir), inputs.FORM)


@query(
    """SELECT doc_id, CAST(quality AS INTEGER) AS quality_flag, CAST(NULL AS INTEGER) AS quality_double_flag,
      CAST(CASE WHEN toxic = 1 THEN 0 WHEN toxic = 0 THEN 1 END AS INTEGER) AS clean_flag FROM labels"""
)
def yes_no_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators from whole numbers, from doubles (``1.0`` is no yes) and with other answer words."""
    labels = table(spark, sf_dir, "labels").withColumn("quality_double", F.col("quality").cast("double"))
    flagged = derive.derive(
        labels, Derivations(flags=[("quality", "quality_flag"), ("quality_double", "quality_double_flag")])
    )
    french = flagged.withColumn("clean", F.when(F.col("toxic") == 0, "oui").otherwise("non"))
    form = Derivations(flags=[("clean", "clean_flag")], true_values=("oui",), false_values=("non",))
    return derive.derive(french, form).select("doc_id", "quality_flag", "quality_double_flag", "clean_flag")


@query(inputs.long_sql(inputs.SUBMISSIONS_SQL))
def unpivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every derived submission column as (data_element, value) rows."""
    wide = derive.derive(inputs.submissions(spark, sf_dir), inputs.FORM)
    return reshape.unpivot_long(wide, inputs.RULES.ids)


@query(
    f"""SELECT periode AS PERIOD, reference_externe AS ORG_UNIT, data_element_id AS DX_UID, value AS VALUE,
      CASE WHEN COC IS NULL OR COC = '' THEN 'HllvX50cXC0' ELSE COC END AS CATEGORY_OPTION_COMBO,
      'HllvX50cXC0' AS ATTRIBUTE_OPTION_COMBO, 'DATA_ELEMENT' AS DATA_TYPE
    FROM ({inputs.long_sql(inputs.SUBMISSIONS_SQL)}) l LEFT JOIN ({inputs.MAPPING_SQL}) m
      ON lower(l.data_element) = lower(m.name)"""
)
def map_and_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join to the mapping (one name, many targets), canonical names, defaults and constants."""
    mapped = canonical.map_names(unpivot_long(spark, sf_dir), inputs.mapping(spark))
    return canonical.name_points(mapped, inputs.RULES)


@query(inputs.POINTS_SQL)
def canonical_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period, unit and value filters on mapped points, step by step."""
    return canonical.as_points(
        canonical.keep_points(map_and_default(spark, sf_dir), inputs.RULES, inputs.AS_OF)
    )


@query(inputs.POINTS_SQL)
def canonical_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points from the composite job: only mapped columns are unpivoted, no join."""
    return inputs.points(spark, sf_dir)


# A mapping of some thousand targets: most are for names of other forms, each name of this one has two.
_WIDE_COPIES = 500
_WIDE_MAPPING_SQL = f"""SELECT CASE WHEN i < 2 THEN name ELSE concat(name, ' of system ', i) END AS own, name,
    CASE WHEN i = 1 THEN data_element_id || '-2' ELSE data_element_id END AS data_element_id, COC, CC, Calcul
  FROM ({inputs.MAPPING_SQL}) CROSS JOIN (SELECT {{numbers}}) AS n"""


@query(
    f"""WITH m AS ({_WIDE_MAPPING_SQL.format(numbers=f"unnest(range({_WIDE_COPIES})) AS i")})
    {inputs.points_sql(inputs.SUBMISSIONS_SQL).replace(f"({inputs.MAPPING_SQL}) m", "(SELECT * REPLACE (own AS name) FROM m) m")}"""
)
def canonical_points_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points under a mapping that is joined by name and gives several targets a name."""
    wide = spark.sql(_WIDE_MAPPING_SQL.format(numbers=f"explode(sequence(0, {_WIDE_COPIES - 1})) AS i"))
    mapping = wide.withColumn("name", F.col("own")).drop("own")
    return transform.canonical_points(
        inputs.submissions(spark, sf_dir), mapping, inputs.FORM, inputs.RULES, inputs.AS_OF, literal_targets=5
    )


@query(
    f"""SELECT periode, count(*) AS n_unmapped FROM ({inputs.long_sql(inputs.SUBMISSIONS_SQL)}) l
    WHERE NOT EXISTS (SELECT 1 FROM ({inputs.MAPPING_SQL}) m
      WHERE lower(m.name) = lower(l.data_element) AND m.data_element_id IS NOT NULL) GROUP BY periode"""
)
def unmapped_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers per period whose question has no target."""
    mapped = canonical.map_names(unpivot_long(spark, sf_dir), inputs.mapping(spark))
    lost = mapped.where(F.col("data_element_id").isNull())
    return lost.groupBy("periode").agg(F.count(F.lit(1)).alias("n_unmapped"))


@query(
    r"""SELECT doc_id, replace(trim(regexp_replace(strip_accents(text), '[^\p{L}\p{N}_\s-]', '', 'g'),
      concat(' ', chr(10), chr(13), chr(9))), ' ', '_').lower() AS cleaned FROM documents"""
)
def clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name cleaning on whole texts: accents and punctuation go, spaces become underscores."""
    return table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


_TYPES = "['click', 'error', 'purchase', 'signup', 'view']"


@query(
    f"""WITH u AS (SELECT user_id, CASE WHEN max(value) < 50 THEN NULL ELSE list(DISTINCT event_type) END AS kinds
      FROM events GROUP BY user_id)
    SELECT user_id, {', '.join(f"CAST(coalesce(list_contains(kinds, '{t}'), false) AS TINYINT) AS kinds_{t}"
                               for t in ('click', 'error', 'purchase', 'signup', 'view'))} FROM u"""
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list column as one 0/1 column per element; a null list gives zeros."""
    kinds = F.when(F.max("value") >= 50, F.collect_set("event_type"))
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(kinds.alias("kinds"))
    return choices.one_hot(users)


@query(
    f"""WITH u AS (SELECT user_id, CASE WHEN max(value) < 50 THEN NULL ELSE list(DISTINCT event_type) END AS kinds
      FROM events GROUP BY user_id)
    SELECT user_id, {', '.join(f"CAST(coalesce(list_contains(kinds, '{t}'), false) AS TINYINT) AS kinds_{t}"
                               for t in ('click', 'never', 'view'))},
      len(list_filter(coalesce(kinds, []), lambda k: k NOT IN ('click', 'view')))::INTEGER AS n_others,
      array_to_string(list_sort(list_filter(coalesce(kinds, []), lambda k: k NOT IN ('click', 'view'))), ',') AS others FROM u"""
)
def one_hot_of_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of known choices, seen or not, without a look at the data; other elements stay in a map."""
    kinds = F.when(F.max("value") >= 50, F.collect_set("event_type"))
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(kinds.alias("kinds"))
    known = spark.createDataFrame([("kinds", k) for k in ("view", "click", "never")], "question string, element string")
    hot = choices.one_hot(users, elements=known)
    others = F.map_keys("kinds_others")
    return hot.withColumns({"n_others": F.size(others), "others": F.array_join(F.array_sort(others), ",")}).drop("kinds_others")


@query(
    """WITH w AS (SELECT p_partkey, list_distinct(string_split(p_name, ' ')) AS ws FROM part)
    SELECT p_partkey, unnest(ws) AS word, CAST(1 AS TINYINT) AS has FROM w"""
)
def choice_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List columns as maps of element to 1, read as rows."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return choices.choice_maps(part).select("p_partkey", F.explode("words").alias("word", "has"))


@query(
    """SELECT DISTINCT 'words' AS question, unnest(string_split(p_name, ' ')) AS element FROM part
    UNION SELECT DISTINCT 'kind', p_type FROM part"""
)
def list_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct elements of all list columns in one scan."""
    part = table(spark, sf_dir, "part").select(
        F.split("p_name", " ").alias("words"), F.array("p_type").alias("kind")
    )
    return choices.list_elements(part)


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per list element."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return choices.explode_list(part, "words", "word")


@query(
    """SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS c_nationkey,
      CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment,
      concat('nation ', n_name, ' / ', c_mktsegment) AS answers
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
)
def replace_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes as labels: single-select, single-select with unlabelled codes, and multi-select."""
    nation = table(spark, sf_dir, "nation")
    code = F.col("n_nationkey").cast("string").alias("code")
    segments = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("code")).distinct()
    labels = nation.select(F.lit("c_nationkey").alias("question"), code, F.col("n_name").alias("label"))
    labels = labels.unionByName(labels.withColumn("question", F.lit("answers")))
    labels = labels.unionByName(
        segments.where(F.col("code").isin("BUILDING", "MACHINERY")).select(
            F.lit("c_mktsegment").alias("question"), "code", F.lower("code").alias("label")
        )
    )
    customer = table(spark, sf_dir, "customer").withColumn(
        "answers", F.concat_ws(" ", F.lit("nation"), F.col("c_nationkey"), F.lit("/"), F.col("c_mktsegment"))
    )
    labelled = choices.replace_labels(
        customer.select("c_custkey", "c_nationkey", "c_mktsegment", "answers"), labels, ["answers"]
    )
    return labelled.withColumn("answers", F.array_join("answers", " "))


@query(
    """WITH labels AS (SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS label FROM part WHERE p_partkey % 5 > 0),
    answers AS (SELECT l_orderkey, list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS codes,
      min(l_partkey) AS one, max(l_returnflag) AS flag FROM lineitem GROUP BY l_orderkey),
    parts AS (SELECT l_orderkey, unnest(codes) AS code, generate_subscripts(codes, 1) AS nth FROM answers)
    SELECT l_orderkey, coalesce(o.label, CAST(one AS VARCHAR)) AS one, flag, many
    FROM answers LEFT JOIN labels o ON o.code = CAST(one AS VARCHAR) JOIN (
      SELECT l_orderkey, string_agg(coalesce(label, code), '|' ORDER BY nth) AS many FROM parts LEFT JOIN labels USING (code)
      GROUP BY l_orderkey) USING (l_orderkey)"""
)
def replace_many_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A choice table that is joined: single-select and multi-select answers, in order, some codes without a label."""
    part = table(spark, sf_dir, "part").where("p_partkey % 5 > 0").withColumn("code", F.col("p_partkey").cast("string"))
    labels = part.select(F.explode(F.array(F.lit("one"), F.lit("many"))).alias("question"), "code", F.col("p_name").alias("label"))
    codes = F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").cast("string").alias("code"))))
    answers = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("one"),
        F.max("l_returnflag").alias("flag"),
        F.array_join(F.transform(codes, lambda x: x["code"]), " ").alias("many"),
    )
    labelled = choices.replace_labels(answers, labels, ["many"], literal_choices=20)
    return labelled.withColumn("many", F.array_join("many", "|"))


@query(
    """SELECT CAST(o_orderkey AS DOUBLE) AS id, CAST(o_totalprice AS VARCHAR) AS amount, o_orderstatus AS tag FROM orders
    UNION ALL SELECT CAST(event_id AS DOUBLE), CAST(value AS VARCHAR), NULL FROM events
    UNION ALL SELECT l_orderkey + 0.5, CAST(l_linenumber AS VARCHAR), l_linestatus FROM lineitem
    UNION ALL SELECT CAST(s_suppkey AS DOUBLE), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier"""
)
def relaxed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of frames whose columns are whole numbers, doubles, text or always null."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_totalprice AS amount", "o_orderstatus AS tag"
    )
    events = table(spark, sf_dir, "events").selectExpr("event_id AS id", "value AS amount", "NULL AS tag")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey + 0.5D AS id", "l_linenumber AS amount", "l_linestatus AS tag"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS INT) AS id", "s_name AS amount", "s_nationkey AS tag"
    )
    return reshape.union_relaxed([orders, events, lines, suppliers])


@query("SELECT s_acctbal AS A_bal, s_name AS b_name, s_suppkey AS c_key FROM supplier")
def sorted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in alphabetical order, rows by every column."""
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS c_key", "s_name AS b_name", "s_acctbal AS A_bal")
    return columns.sort_rows(columns.sort_columns(supplier))


@query(
    """SELECT s_suppkey AS age_ans_1, s_name AS age_ans_3, s_acctbal AS age_ans_2, s_nationkey AS deja_vu FROM supplier"""
)
def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned column names; those that clash get a suffix that no other has."""
    names = ["Âge (ans)", "age ans", "AGE_ANS_2", "Déjà vu?"]
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    return columns.clean_columns(supplier.toDF(*names))


_STANDARD_SQL = """SELECT 'DATA_ELEMENT' AS DATA_TYPE, event_type AS DX_UID, strftime(ts, '%Y%m') AS PERIOD,
    concat('U', user_id) AS ORG_UNIT, 'coc' AS CATEGORY_OPTION_COMBO, 'aoc' AS ATTRIBUTE_OPTION_COMBO,
    CAST(NULL AS VARCHAR) AS RATE_TYPE, 'AGGREGATED' AS DOMAIN_TYPE, CAST(value AS VARCHAR) AS VALUE FROM events
  UNION ALL SELECT 'REPORTING_RATE', split_part(dx, '.', 1), CASE WHEN contains(dx, '.') THEN strftime(ts, '%Y%m') ELSE strftime(ts, '%Y%m') END,
    concat('U', user_id), NULL, NULL, CASE WHEN contains(dx, '.') THEN split_part(dx, '.', 2) END, 'AGGREGATED',
    CAST(value AS VARCHAR) FROM (SELECT *, CASE WHEN event_type = 'error' THEN event_type
      ELSE concat(event_type, '.ACTUAL_REPORTS') END AS dx FROM events)
  UNION ALL SELECT 'INDICATOR', event_type, strftime(ts, '%Y%m'), concat('U', user_id), NULL, NULL, NULL, 'TRACKER',
    CAST(value AS VARCHAR) FROM events"""


def _event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_type",
        F.date_format("ts", "yyyyMM").alias("period"),
        F.concat(F.lit("U"), F.col("user_id")).alias("orgUnit"),
        F.col("value").cast("string").alias("value"),
    )


@query(_STANDARD_SQL)
def standard_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three kinds of extracted values in the nine standard columns."""
    events = _event_values(spark, sf_dir)
    elements = events.withColumnRenamed("event_type", "dataElement").withColumns(
        {"categoryOptionCombo": F.lit("coc"), "attributeOptionCombo": F.lit("aoc")}
    )
    analytics = events.withColumnsRenamed({"period": "pe", "orgUnit": "ou"})
    dx = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.concat("event_type", F.lit(".ACTUAL_REPORTS"))
    )
    parts = [
        standard.to_standard(elements),
        standard.to_standard(analytics.withColumn("dx", dx), "REPORTING_RATE"),
        standard.to_standard(analytics.withColumn("dx", F.col("event_type")), "INDICATOR", "TRACKER"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    f"""SELECT l_linenumber, CAST(l_quantity * 1e6 * l_linenumber AS VARCHAR) AS big, CAST(l_discount AS VARCHAR) AS small,
      CAST(l_linenumber AS VARCHAR) AS whole, CAST(l_quantity = 1 AS VARCHAR) AS flag, count(*) AS n
    FROM lineitem GROUP BY ALL"""
)
def value_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text without exponents."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_linenumber", "l_quantity * 1e6 * l_linenumber AS big", "l_discount AS small",
        "l_linenumber AS whole", "l_quantity = 1 AS flag",
    )
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    texts = [value_to_string(F.col(c), kinds[c]).alias(c) for c in ("big", "small", "whole", "flag")]
    return lines.select("l_linenumber", *texts).groupBy("l_linenumber", "big", "small", "whole", "flag").agg(
        F.count(F.lit(1)).alias("n")
    )


_TEXTS_SQL = """SELECT 'props' AS DX_UID, props AS VALUE FROM events
  UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM events
  UNION ALL SELECT 'name', p_name FROM part
  UNION ALL SELECT 'size', CASE WHEN p_size < 10 THEN concat(p_size, 'd') WHEN p_size < 20 THEN concat(' ', p_size)
    WHEN p_size < 30 THEN concat(p_size, '_0') WHEN p_size < 40 THEN concat('-', p_size, 'e2')
    WHEN p_size = 40 THEN 'NaN' WHEN p_size = 41 THEN '-nan' WHEN p_size = 42 THEN 'Infinity' WHEN p_size = 43 THEN '-inf'
    WHEN p_size = 44 THEN 'nano' WHEN p_size = 45 THEN '+Infinit'
    ELSE concat('.', p_size) END FROM part
  UNION ALL SELECT 'status', nullif(o_orderstatus, 'F') FROM orders"""
_NUMERIC_SQL = f"coalesce(regexp_matches(VALUE, '{DECIMAL_PATTERN}') OR regexp_matches(VALUE, '{SPECIAL_PATTERN}'), false)"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in ("events", "part", "orders")}
    text = _TEXTS_SQL.replace("AS VARCHAR", "AS STRING")
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(text, **tables)


@query(
    f"""SELECT DX_UID, count(*) AS count, min(VALUE) AS sample_alpha_value FROM ({_TEXTS_SQL})
    WHERE NOT {_NUMERIC_SQL} GROUP BY DX_UID"""
)
def non_numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets with values that are not numbers; nulls count, number look-alikes too."""
    return quality.non_numeric_profile(_texts(spark, sf_dir))


@query(f"SELECT VALUE, {_NUMERIC_SQL} AS numeric, count(*) AS n FROM ({_TEXTS_SQL}) GROUP BY ALL")
def numeric_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric test on every kind of text."""
    flagged = _texts(spark, sf_dir).withColumn("numeric", is_numeric(F.col("VALUE")))
    return flagged.groupBy("VALUE", "numeric").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS PERIOD FROM (SELECT unnest(generate_series(
      date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)"""
)
def period_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods from the first to the last order."""
    span = table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return span.select(F.explode(months_between(F.col("first"), F.col("last"))).alias("PERIOD"))


@query(
    """SELECT o_orderpriority, CAST(year(m) * 100 + month(m) AS INTEGER) AS PERIOD FROM (
      SELECT o_orderpriority, unnest(list_transform([1, 2, 3], lambda i:
        CAST(date_trunc('month', max(o_orderdate)) AS DATE) - to_months(CAST(i AS INTEGER)))) AS m
      FROM orders GROUP BY o_orderpriority)"""
)
def previous_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three periods before the latest order of each priority."""
    latest = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.to_date(F.max("o_orderdate")).alias("last")
    )
    return latest.select("o_orderpriority", F.explode(previous_months(F.col("last"), 3)).alias("PERIOD"))


@query(
    """WITH t AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 'O' THEN concat(year(o_orderdate), '-', month(o_orderdate), '-', day(o_orderdate))
        ELSE strftime(o_orderdate, '%d/%m/%Y') END AS txt, o_orderdate, o_orderstatus FROM orders)
    SELECT txt, CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) END AS period,
      o_orderstatus <> 'P' AS valid, count(*) AS n FROM t GROUP BY ALL"""
)
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO date check (single digits allowed) and the period of the date."""
    texts = table(spark, sf_dir, "orders").selectExpr(
        """CASE o_orderstatus WHEN 'F' THEN date_format(o_orderdate, 'yyyy-MM-dd')
        WHEN 'O' THEN concat(year(o_orderdate), '-', month(o_orderdate), '-', day(o_orderdate))
        ELSE date_format(o_orderdate, 'dd/MM/yyyy') END AS txt"""
    )
    day = iso_date(F.col("txt"))
    checked = texts.select("txt", period_of(day).alias("period"), day.isNotNull().alias("valid"))
    return checked.groupBy("txt", "period", "valid").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH p AS (SELECT {inputs.ORDER_PERIOD} AS p, CASE WHEN o_orderstatus = 'P' THEN 60 ELSE 0 END AS shift FROM orders)
    SELECT CAST(p + shift AS INTEGER) AS PERIOD, shift = 0 AS valid,
      CASE WHEN shift = 0 THEN strftime(make_date(p // 100, p % 100, 1), '%Y-%m-%d') END AS first_day, count(*) AS n
    FROM p GROUP BY ALL"""
)
def period_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed periods and their first day."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        f"{inputs.ORDER_PERIOD} + CASE WHEN o_orderstatus = 'P' THEN 60 ELSE 0 END AS PERIOD"
    )
    valid = is_month(F.col("PERIOD"))
    first = F.when(valid, period_start(F.when(valid, F.col("PERIOD"))).cast("string"))
    return orders.groupBy("PERIOD", valid.alias("valid"), first.alias("first_day")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    f"""WITH o AS (SELECT o_orderkey, {inputs.ORDER_PERIOD} AS PERIOD FROM orders)
    SELECT 'only' AS choice, o_orderkey, PERIOD FROM o WHERE PERIOD = 199605
    UNION ALL SELECT 'list', o_orderkey, PERIOD FROM o WHERE PERIOD IN (199605, 199606)
    UNION ALL SELECT 'all', o_orderkey, PERIOD FROM o
    UNION ALL SELECT 'table', o_orderkey, PERIOD FROM o WHERE PERIOD IN
      (SELECT DISTINCT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) FROM lineitem WHERE l_shipdate < DATE '1996-01-01')"""
)
def period_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precedence of one period, a list and everything, and membership in a period table."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{inputs.ORDER_PERIOD} AS PERIOD")
    shipped = table(spark, sf_dir, "lineitem").where("l_shipdate < DATE '1996-01-01'")
    periods = shipped.select(period_of(F.col("l_shipdate")).alias("PERIOD")).distinct()
    chosen = {
        "only": select_periods(orders, 199605, [199501]),
        "list": select_periods(orders, None, [199605, 199606]),
        "all": select_periods(orders),
        "table": in_periods(orders, periods),
    }
    parts = [df.select(F.lit(name).alias("choice"), "o_orderkey", "PERIOD") for name, df in chosen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(f"SELECT DISTINCT {inputs.ORDER_PERIOD} AS PERIOD FROM orders")
def period_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periods that occur."""
    return distinct_periods(table(spark, sf_dir, "orders").selectExpr(f"{inputs.ORDER_PERIOD} AS PERIOD"))


@query(
    f"""SELECT o_orderkey, {inputs.ORDER_PERIOD} AS periode, strftime(o_orderdate, '%Y-%m-%d') AS updated_at FROM orders
    WHERE {inputs.ORDER_PERIOD} BETWEEN 199603 AND 199811 AND strftime(o_orderdate, '%Y-%m-%d') >= '1997-02-10'"""
)
def submission_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end period, and changes since a day."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(inputs.ORDER_PERIOD).alias("periode"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"),
    )
    return select_submissions(orders, start=199603, end=199811, updated_since=date(1997, 2, 10).isoformat())
