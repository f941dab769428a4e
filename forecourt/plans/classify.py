"""CLS-* registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import text as T
from forecourt.functions.fmt import big, rnd
from forecourt.operators import classify as C
from forecourt.plans.registry import query
from forecourt.sources.fixtures import places
from forecourt.sources.tables import LINE_KEY, read

ORACLE: dict[str, str] = {}


def sql(name, text):
    ORACLE[name] = text.strip()


def _place_mapping(spark, d):
    return places(spark, d).filter(F.col("place_v2") != "ASIA").select(
        F.col("place").alias("Original_Value"), F.col("place_v2").alias("Mapped_Value"))


def _cls01(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey")
    n = read(spark, d, "nation", "n_nationkey", "n_name")
    x = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("place"))
    return C.group_values(x, "place", _place_mapping(spark, d), "place_group", "c_custkey")


@query("cls_01_value_grouping")
def cls01(spark, d):
    return _cls01(spark, d)[0]


_PM = "pm AS (SELECT n.n_name AS o, r.r_name AS m FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'ASIA')"
_CP = "cp AS (SELECT c.c_custkey, n.n_name AS place FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"
sql("cls_01_value_grouping", f"WITH {_PM}, {_CP} SELECT cp.c_custkey, cp.place, pm.m AS place_group FROM cp LEFT JOIN pm ON cp.place = pm.o")


@query("cls_01_unmapped_report")
def cls01u(spark, d):
    return _cls01(spark, d)[1]


sql("cls_01_unmapped_report", f"WITH {_PM}, {_CP} SELECT DISTINCT cp.place, cp.c_custkey FROM cp LEFT JOIN pm ON cp.place = pm.o WHERE pm.m IS NULL")


@query("cls_01_fail_flag")
def cls01f(spark, d):
    return _cls01(spark, d)[2]


sql("cls_01_fail_flag", f"WITH {_PM}, {_CP} SELECT CAST(count(*) > 0 AS BIGINT) AS non_parametrized_data_flag FROM (SELECT DISTINCT cp.place, cp.c_custkey FROM cp LEFT JOIN pm ON cp.place = pm.o WHERE pm.m IS NULL)")


def _sale_places(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    n = read(spark, d, "nation", "n_nationkey", "n_name")
    x = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    desc = (F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("DCS stand "), F.col("c_mktsegment")))
             .when(F.col("c_custkey") % 11 == 0, F.concat(F.lit("Stand "), F.col("c_mktsegment")))
             .otherwise(F.concat(F.lit("Stand "), F.col("n_name"), F.lit(" "), F.col("c_mktsegment"))))
    return x.select("c_custkey", desc.alias("sale_place"))


def _districts(spark, d):
    from pyspark.sql import Window
    pl = places(spark, d)
    w = Window.orderBy("place_v2", "place")
    # dictionary order: groups then districts, numbered on the 25-row table
    return pl.select(F.col("place").alias("district"), F.col("place_v2").alias("group"),
                     F.row_number().over(w).alias("priority"))


@query("cls_02_sell_place")
def cls02(spark, d):
    return C.sell_place(_sale_places(spark, d), "sale_place", _districts(spark, d), "DCS", "Lisboa").select(
        "c_custkey", "place_level_2", "place_level_1")


sql("cls_02_sell_place", """WITH sp AS (SELECT c.c_custkey, CASE WHEN c.c_custkey % 7 = 0 THEN 'DCS stand ' || c.c_mktsegment
  WHEN c.c_custkey % 11 = 0 THEN 'Stand ' || c.c_mktsegment ELSE 'Stand ' || n.n_name || ' ' || c.c_mktsegment END AS sale_place
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
ds AS (SELECT n.n_name AS district, r.r_name AS grp, row_number() OVER (ORDER BY r.r_name, n.n_name) AS priority FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
hit AS (SELECT sale_place, arg_min(district, priority) AS d FROM (SELECT DISTINCT sale_place FROM sp) JOIN ds ON contains(sale_place, district) GROUP BY sale_place),
l2 AS (SELECT sp.c_custkey, coalesce(hit.d, CASE WHEN substr(sp.sale_place, 1, 3) = 'DCS' THEN 'Lisboa' END) AS place_level_2 FROM sp LEFT JOIN hit USING (sale_place))
SELECT l2.c_custkey, l2.place_level_2, ds.grp AS place_level_1 FROM l2 LEFT JOIN ds ON l2.place_level_2 = ds.district""")


def _model_desc(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size", "p_brand")
    desc = F.concat(F.when(F.col("p_partkey") % 3 == 0, F.lit("novo ")).otherwise(F.lit("")), F.col("p_name"), F.lit(" "),
                    F.col("p_type"), F.lit(" x"), (F.col("p_size") % 9).cast("string"), F.lit(" "), F.col("p_brand"))
    return p.select("p_partkey", desc.alias("model_desc"))


_MD = """md AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'novo ' ELSE '' END || p_name || ' ' || p_type || ' x' || CAST(p_size % 9 AS VARCHAR) || ' ' || p_brand AS model_desc FROM part)"""


@query("cls_03_model_name")
def cls03(spark, d):
    m = _model_desc(spark, d)
    return m.select("p_partkey", C.model_name(F.col("model_desc"), "first_word").alias("model_first_word"),
                    C.model_name(F.col("model_desc"), "drop_last_three").alias("model_trimmed"))


sql("cls_03_model_name", f"""WITH {_MD} SELECT p_partkey, CASE WHEN lower(split_part(model_desc, ' ', 1)) = 'novo' THEN split_part(model_desc, ' ', 2) ELSE split_part(model_desc, ' ', 1) END AS model_first_word,
  array_to_string(string_split(model_desc, ' ')[1:greatest(len(string_split(model_desc, ' ')) - 3, 0)], ' ') AS model_trimmed FROM md""")


@query("cls_04_engine_token")
def cls04(spark, d):
    m = _model_desc(spark, d).withColumn("version", F.lower(F.concat_ws(" ", F.lit("v"), F.col("model_desc"))))
    return m.select("p_partkey", C.engine_token(F.col("version")).alias("engine"))


sql("cls_04_engine_token", f"""WITH {_MD}, v AS (SELECT p_partkey, lower('v ' || model_desc) AS version FROM md)
SELECT p_partkey, CASE WHEN {' OR '.join(f"contains(version, 'x{i} ')" for i in range(1, 8))} THEN split_part(version, ' ', 2) ELSE split_part(version, ' ', 1) END AS engine FROM v""")


@query("cls_05_interior_type")
def cls05(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name")
    return p.select("p_partkey", T.regex_extract_default("p_name", r"\b(leather|ring|bolt)\b", "tecido").alias("interior_type"))


sql("cls_05_interior_type", r"SELECT p_partkey, coalesce(nullif(regexp_extract(p_name, '\b(leather|ring|bolt)\b', 1), ''), 'tecido') AS interior_type FROM part")


@query("cls_06_version")
def cls06(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_type")
    return p.select("p_partkey", T.regex_extract_default("p_type", r"^(ECONOMY|STANDARD|PROMO)", "Sem Info Versão").alias("version"))


sql("cls_06_version", "SELECT p_partkey, coalesce(nullif(regexp_extract(p_type, '^(ECONOMY|STANDARD|PROMO)', 1), ''), 'Sem Info Versão') AS version FROM part")


def option_lines(spark, d):
    li = read(spark, d, "lineitem", *LINE_KEY)
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size")
    x = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return x.select(*LINE_KEY, F.lower(F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string"))).alias("option"),
                    F.lower(F.col("p_name")).alias("colour_text"))


# Fixed fixture vocabularies / option tests (invented words of the part names).
COLOURS = ["red", "blue", "green", "black", "white", "silver"]


def _tok(word):
    return F.array_contains(F.col("_tok"), word)


def _flags():
    has = lambda w: F.col("option").contains(w)
    return {"navigation": has("widget"), "roof_bars": has("bolt"), "alarm": has("ring"),
            "ac_auto": has("red") & has("small"), "sunroof": has("blue") & has("large"),
            "sensors": _tok("standard") & F.exists("_tok", lambda t: t.contains("and")),
            "gearbox_auto": (_tok("promo") | _tok("medium")) & F.exists("_tok", lambda t: t.contains("ium")),
            "led": (_tok("red") & _tok("widget") & ~_tok("bolt")) | (_tok("white") & _tok("led"))}


def _version_rules():
    return [(_tok("large"), "advantage"),
            ((_tok("small") | _tok("medium")) & _tok("red") & _tok("ring"), "line sport"),
            ((_tok("small") | _tok("medium")) & _tok("blue") & _tok("bolt"), "line urban"),
            (_tok("economy") & _tok("green"), "xline")]


def vehicle_features(spark, d):
    return C.option_features(option_lines(spark, d), "l_orderkey", LINE_KEY[1:], "option", "colour_text",
                             _flags(), _version_rules(), COLOURS)


FLAG_NAMES = ["navigation", "roof_bars", "alarm", "ac_auto", "sunroof", "sensors", "gearbox_auto", "led"]


@query("cls_07_option_features")
def cls07(spark, d):
    return vehicle_features(spark, d).select("l_orderkey", *FLAG_NAMES, "version", "rims", "colour")


def _cls07_sql():
    has = lambda w: f"contains(option, '{w}')"
    tk = lambda w: f"list_contains(tok, '{w}')"
    flags = {"navigation": has("widget"), "roof_bars": has("bolt"), "alarm": has("ring"),
             "ac_auto": f"{has('red')} AND {has('small')}", "sunroof": f"{has('blue')} AND {has('large')}",
             "sensors": f"{tk('standard')} AND len(list_filter(tok, lambda t: contains(t, 'and'))) > 0",
             "gearbox_auto": f"({tk('promo')} OR {tk('medium')}) AND len(list_filter(tok, lambda t: contains(t, 'ium'))) > 0",
             "led": f"({tk('red')} AND {tk('widget')} AND NOT {tk('bolt')}) OR ({tk('white')} AND {tk('led')})"}
    ver = "NULL"
    for cond, val in [(tk("large"), "advantage"), (f"({tk('small')} OR {tk('medium')}) AND {tk('red')} AND {tk('ring')}", "line sport"),
                      (f"({tk('small')} OR {tk('medium')}) AND {tk('blue')} AND {tk('bolt')}", "line urban"),
                      (f"{tk('economy')} AND {tk('green')}", "xline")]:
        ver = f"CASE WHEN {cond} THEN '{val}' ELSE {ver} END"
    rim = "list_max(list_filter([" + ", ".join(f"CASE WHEN {tk(str(s))} THEN {s} END" for s in range(15, 21)) + "], lambda v: v IS NOT NULL))"
    order = "(l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)"
    colour = "NULL"
    for c in reversed(COLOURS):
        colour = f"CASE WHEN list_contains(string_split(ct, ' '), '{c}') THEN '{c}' ELSE {colour} END"
    return f"""WITH ol AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
  lower(concat_ws(' ', p.p_name, p.p_type, CAST(p.p_size AS VARCHAR))) AS option, lower(p.p_name) AS colour_text FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
t AS (SELECT *, string_split(option, ' ') AS tok FROM ol),
c AS (SELECT *, {ver} AS ver, {rim} AS rim FROM t),
g AS (SELECT l_orderkey, {', '.join(f"CAST(max(CAST({e} AS INT)) AS BIGINT) AS {n}" for n, e in flags.items())},
  arg_max(ver, {order}) FILTER (WHERE ver IS NOT NULL) AS version, CAST(coalesce(max(rim), 0) AS BIGINT) AS rims, arg_min(colour_text, {order}) AS ct FROM c GROUP BY l_orderkey)
SELECT l_orderkey, {', '.join(FLAG_NAMES)}, version, rims, coalesce({colour}, 'undefined') AS colour FROM g"""


sql("cls_07_option_features", _cls07_sql())


@query("cls_08_option_features_regex")
def cls08(spark, d):
    lines = option_lines(spark, d)
    flags = {"navigation": F.col("option").rlike(r"\bwidget\b"), "alarm": F.col("option").rlike(r"^(red|blue) ring"),
             "sensors": F.col("option").rlike(r"standard.*\b(1[0-9])\b")}
    f = C.option_features(lines, "l_orderkey", LINE_KEY[1:], "option", "colour_text", flags, [], COLOURS)
    return f.select("l_orderkey", "navigation", "alarm", "sensors", "rims", "colour")


def _colour_sql():
    colour = "NULL"
    for c in reversed(COLOURS):
        colour = f"CASE WHEN list_contains(string_split(ct, ' '), '{c}') THEN '{c}' ELSE {colour} END"
    return colour


sql("cls_08_option_features_regex", f"""WITH ol AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
  lower(concat_ws(' ', p.p_name, p.p_type, CAST(p.p_size AS VARCHAR))) AS option, lower(p.p_name) AS colour_text FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
t AS (SELECT *, string_split(option, ' ') AS tok FROM ol),
g AS (SELECT l_orderkey, CAST(max(CAST(regexp_matches(option, '\\bwidget\\b') AS INT)) AS BIGINT) AS navigation,
  CAST(max(CAST(regexp_matches(option, '^(red|blue) ring') AS INT)) AS BIGINT) AS alarm,
  CAST(max(CAST(regexp_matches(option, 'standard.*\\b(1[0-9])\\b') AS INT)) AS BIGINT) AS sensors,
  CAST(coalesce(max(list_max(list_filter([{', '.join(f"CASE WHEN list_contains(tok, '{s}') THEN {s} END" for s in range(15, 21))}], lambda v: v IS NOT NULL))), 0) AS BIGINT) AS rims,
  arg_min(colour_text, (l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS ct FROM t GROUP BY l_orderkey)
SELECT l_orderkey, navigation, alarm, sensors, rims, coalesce({_colour_sql()}, 'undefined') AS colour FROM g""")

CUTOFF = "1998-01-01"


def _models(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    model = F.concat(F.lit("s"), (F.col("o_custkey") % 6).cast("string"), F.lit(" series "), F.col("o_orderpriority"), F.lit(" 5P edition"))
    return o.select("o_orderkey", model.alias("model_desc"), "o_orderdate")


@query("cls_09_model_cleanup")
def cls09(spark, d):
    return C.model_cleanup(_models(spark, d), "model_desc", "o_orderdate", CUTOFF).select("o_orderkey", "model")


sql("cls_09_model_cleanup", f"""WITH m AS (SELECT o_orderkey, 's' || CAST(o_custkey % 6 AS VARCHAR) || ' series ' || o_orderpriority || ' 5P edition' AS model_desc, o_orderdate FROM orders),
f AS (SELECT *, min(o_orderdate) OVER (PARTITION BY model_desc) AS first, string_split(model_desc, ' ') AS tk FROM m),
k AS (SELECT o_orderkey, array_to_string(CASE WHEN first < TIMESTAMP '{CUTOFF}' THEN tk[1:greatest(len(tk) - 3, 0)] ELSE tk[4:4 + greatest(len(tk) - 3, 0) - 1] END, ' ') AS m0 FROM f)
SELECT o_orderkey, regexp_replace(regexp_replace(m0, '(?i)^s([0-9])', 'Serie \\1'), '\\b[53]P\\b', '5p', 'g') AS model FROM k""")


@query("cls_10_standard_equipment")
def cls10(spark, d):
    f = vehicle_features(spark, d)
    o = read(spark, d, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    x = f.join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("model", F.substring("o_orderpriority", 1, 1))
    yr = F.year("o_orderdate")
    rims = C.ordered_when(F.col("rims"), [((F.col("model") == "1") & (F.col("rims") == 0), 16),
                                          ((F.col("model") == "2") & (F.col("rims") == 0), 16),
                                          ((F.col("model") == "4") & (F.col("rims") == 0), 17)])
    led = C.ordered_when(F.col("led"), [((F.col("model") == "3") & (yr >= 1997), 1), ((F.col("model") == "4") & (yr >= 1998), 1)])
    sensors = C.ordered_when(F.col("sensors"), [((F.col("model") == "4") & (yr >= 1996), 1), (F.col("model") == "5", 1)])
    return x.select("l_orderkey", big(rims).alias("rims"), big(led).alias("led"), big(sensors).alias("sensors"))


sql("cls_10_standard_equipment", f"""WITH {_cls07_sql().replace('WITH ', '', 1).rsplit('SELECT l_orderkey, ', 1)[0].strip()},
feat AS (SELECT l_orderkey, {', '.join(FLAG_NAMES)}, version, rims, coalesce({_colour_sql()}, 'undefined') AS colour FROM g),
x AS (SELECT feat.*, substr(o.o_orderpriority, 1, 1) AS model, year(o.o_orderdate) AS yr FROM feat JOIN orders o ON feat.l_orderkey = o.o_orderkey)
SELECT l_orderkey,
  CAST(CASE WHEN model = '4' AND rims = 0 THEN 17 WHEN model = '2' AND rims = 0 THEN 16 WHEN model = '1' AND rims = 0 THEN 16 ELSE rims END AS BIGINT) AS rims,
  CAST(CASE WHEN model = '4' AND yr >= 1998 THEN 1 WHEN model = '3' AND yr >= 1997 THEN 1 ELSE led END AS BIGINT) AS led,
  CAST(CASE WHEN model = '5' THEN 1 WHEN model = '4' AND yr >= 1996 THEN 1 ELSE sensors END AS BIGINT) AS sensors FROM x""")

# Fixed fixture rule data for the family overrides.
EXACT = {"red ring": "11", "blue bolt": "12"}
PARTIAL = [("^green.*", "13"), ("widget$", "14"), ("^small", "15")]


def _family_input(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_retailprice", "p_size")
    return p.select("p_partkey", F.col("p_name").alias("part_desc"), F.col("p_type").alias("family"),
                    F.col("p_retailprice").alias("average_cost"), F.col("p_size").cast("string").alias("family_code"))


@query("cls_11_family_overrides")
def cls11(spark, d):
    x = _family_input(spark, d)
    cond = [(F.col("part_desc").rlike("^red") & (F.col("family") == "SMALL"), "42"),
            (F.col("part_desc").rlike("^blue|^black") & (F.col("average_cost") >= 1500), "24")]
    return C.description_overrides(x, "part_desc", EXACT, PARTIAL, cond).select("p_partkey", "desc_copy")


def _cls11_sql():
    e = "coalesce(CASE part_desc " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXACT.items()) + " END, part_desc)"
    for pat, val in PARTIAL:
        e = f"regexp_replace({e}, '{pat}', '{val}', 'g')"
    e = (f"CASE WHEN regexp_matches(part_desc, '^blue|^black') AND average_cost >= 1500 THEN '24' "
         f"WHEN regexp_matches(part_desc, '^red') AND family = 'SMALL' THEN '42' ELSE {e} END")
    return f"SELECT p_partkey, {e} AS desc_copy FROM (SELECT p_partkey, p_name AS part_desc, p_type AS family, p_retailprice AS average_cost FROM part)"


sql("cls_11_family_overrides", _cls11_sql())
DROP, REPLACE, OTHERS = ["44", "45"], {"1": "2", "3": "4"}, {"10": "99", "20": "99", "30": "99"}


@query("cls_12_family_replaces")
def cls12(spark, d):
    return C.family_replaces(_family_input(spark, d), "family_code", DROP, REPLACE, OTHERS).select("p_partkey", "family_code")


def _repl(e, mp):
    return "coalesce(CASE " + e + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mp.items()) + " END, " + e + ")"


sql("cls_12_family_replaces", f"SELECT p_partkey, {_repl(_repl('c', REPLACE), OTHERS)} AS family_code FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) AS c FROM part) WHERE c NOT IN ('44', '45')")


@query("cls_13_family_dimension")
def cls13(spark, d):
    p = read(spark, d, "part", "p_size", "p_type", "p_brand")
    dim = p.groupBy("p_size").agg(F.min("p_type").alias("desc"), F.min("p_brand").alias("level_1"), F.max("p_brand").alias("level_2"))
    dim = dim.withColumn("code", F.col("p_size").cast("string")).filter(F.col("code") != "17")
    dim = dim.withColumn("code", F.when(F.col("code") == "7", F.lit("7/17")).otherwise(F.col("code")))
    dim = dim.withColumn("desc", F.when(F.col("desc") == "LARGE", F.lit("LARGE/XL")).otherwise(F.col("desc")))
    dim = dim.withColumn("desc", F.when(F.col("code").isin("10", "20", "30"), F.lit("OUTROS")).otherwise(F.col("desc")))
    return dim.select("code", "desc", F.concat_ws(", ", "level_1", "level_2", "desc").alias("merged_label"))


sql("cls_13_family_dimension", """WITH dim AS (SELECT CAST(p_size AS VARCHAR) AS code0, min(p_type) AS desc0, min(p_brand) AS level_1, max(p_brand) AS level_2 FROM part GROUP BY p_size),
d2 AS (SELECT CASE WHEN code0 = '7' THEN '7/17' ELSE code0 END AS code, CASE WHEN code0 IN ('10', '20', '30') THEN 'OUTROS' WHEN desc0 = 'LARGE' THEN 'LARGE/XL' ELSE desc0 END AS "desc", level_1, level_2 FROM dim WHERE code0 <> '17')
SELECT code, "desc", concat_ws(', ', level_1, level_2, "desc") AS merged_label FROM d2""")


@query("cls_14_part_text_preparation")
def cls14(spark, d):
    x = _family_input(spark, d)
    cleaned = T.punct_to_space(T.strip_accents(F.regexp_replace(F.lower("part_desc"), r"^[\s]+|[\s]+$", "")))
    toks = T.remove_words(T.ws_tokens(T.digits_out(cleaned)), ["the", "of"])
    x = x.withColumn("clean_desc", F.array_join(toks, " "))
    x = x.select("p_partkey", "clean_desc", *T.shape_counts(F.col("part_desc")))
    return x.select("p_partkey", "clean_desc", *[big(c).alias(c) for c in ["n_chars", "n_words", "n_digits", "n_letters", "n_spaces", "n_other"]])


sql("cls_14_part_text_preparation", r"""SELECT p_partkey, array_to_string(list_filter(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(strip_accents(regexp_replace(lower(p_name), '^[\s]+|[\s]+$', '', 'g')), '[[:punct:]]', ' ', 'g'), '^[\s]+|[\s]+$', '', 'g'), '[0-9]', '', 'g'), '\s+'), lambda x: x <> ''), lambda w: w NOT IN ('the', 'of')), ' ') AS clean_desc,
  CAST(length(p_name) AS BIGINT) AS n_chars, CAST(len(list_filter(regexp_split_to_array(p_name, '\s+'), lambda x: x <> '')) AS BIGINT) AS n_words,
  CAST(length(p_name) - length(regexp_replace(p_name, '[0-9]', '', 'g')) AS BIGINT) AS n_digits,
  CAST(length(p_name) - length(regexp_replace(p_name, '\p{L}', '', 'g')) AS BIGINT) AS n_letters,
  CAST(length(p_name) - length(replace(p_name, ' ', '')) AS BIGINT) AS n_spaces,
  CAST(length(p_name) - (length(p_name) - length(regexp_replace(p_name, '[0-9]', '', 'g'))) - (length(p_name) - length(regexp_replace(p_name, '\p{L}', '', 'g'))) - (length(p_name) - length(replace(p_name, ' ', ''))) AS BIGINT) AS n_other
FROM part""")
