"""Classification by rules and vocabularies (CLS-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.clean import bounded_rows
from forecourt.session import small


def group_values(df: DataFrame, col: str, mapping: DataFrame, out: str, id_col: str):
    """CLS-01: map values through a (Original_Value, Mapped_Value) table;
    returns (mapped frame, unmapped report (value, id), fail flag frame).
    The mapping is broadcast while it is small."""
    m = small(mapping.select(F.col("Original_Value").alias("_o"), F.col("Mapped_Value").alias(out)))
    j = df.join(m, F.col(col) == F.col("_o"), "left").drop("_o")
    unmapped = j.filter(F.col(out).isNull() & F.col(col).isNotNull()).select(col, id_col).distinct()
    flag = unmapped.agg((F.count(F.lit(1)) > 0).cast("bigint").alias("non_parametrized_data_flag"))
    return j, unmapped, flag


def first_contained(df: DataFrame, text_col: str, vocab: DataFrame, out: str) -> DataFrame:
    """CLS-02 building block: the first vocabulary entry (by ``priority``)
    contained in the text.  The vocabulary (value, priority) is a bounded
    parameter and becomes one expression: no join, no shuffle."""
    rows = sorted(bounded_rows(vocab.select("value", "priority").where("value IS NOT NULL")), key=lambda r: (r.priority, r.value))
    values = F.array(*[F.lit(r.value) for r in rows]).cast("array<string>")
    return df.withColumn(out, F.get(F.filter(values, lambda v: F.col(text_col).contains(v)), F.lit(0)))


def sell_place(df: DataFrame, text_col: str, districts: DataFrame, default_prefix: str,
               default_place: str) -> DataFrame:
    """CLS-02: level-2 place = first district (dictionary order) contained in
    the description, else the default place when the description starts with
    the prefix; level-1 place = the district's group (CLS-01)."""
    voc = districts.select(F.col("district").alias("value"), "priority")
    x = first_contained(df, text_col, voc, "_d")
    x = x.withColumn("place_level_2", F.coalesce(F.col("_d"), F.when(F.substring(text_col, 1, len(default_prefix)) == default_prefix,
                                                                        F.lit(default_place)))).drop("_d")
    grp = small(districts.select(F.col("district").alias("_k"), F.col("group").alias("place_level_1")))
    return x.join(grp, F.col("place_level_2") == F.col("_k"), "left").drop("_k")


def model_name(desc: Column, approach: str) -> Column:
    """CLS-03: 'first_word' (the second when the first is 'novo'), or
    'drop_last_three' tokens."""
    toks = F.split(desc, " ")
    if approach == "first_word":
        return F.when(F.lower(toks.getItem(0)) == "novo", toks.getItem(1)).otherwise(toks.getItem(0))
    n = F.size(toks)
    return F.array_join(F.slice(toks, 1, F.greatest(n - 3, F.lit(0))), " ")


def engine_token(version: Column, series=("x1 ", "x2 ", "x3 ", "x4 ", "x5 ", "x6 ", "x7 ")) -> Column:
    """CLS-04: second word for X-series versions, else the first."""
    xs = F.lit(False)
    for s in series:
        xs = xs | version.contains(s)
    toks = F.split(version, " ")
    return F.when(xs, toks.getItem(1)).otherwise(toks.getItem(0))


def model_cleanup(df: DataFrame, model_col: str, date_col: str, cutoff: str, out: str = "model") -> DataFrame:
    """CLS-09: per model, by its first sale date: before the cut-off drop the
    last three tokens, from it on drop the first three; then 's<digit>' at
    the start becomes 'Serie <digit>' and a whole-word 5P / 3P becomes 5p."""
    first = df.groupBy(model_col).agg(F.min(date_col).alias("_first"))
    x = df.join(first, model_col, "left")
    toks = F.split(F.col(model_col), " ")
    n = F.size(toks)
    kept = F.when(F.col("_first") < F.to_timestamp(F.lit(cutoff)), F.slice(toks, 1, F.greatest(n - 3, F.lit(0)))) \
            .otherwise(F.slice(toks, F.lit(4), F.greatest(n - 3, F.lit(0))))
    m = F.array_join(kept, " ")
    m = F.regexp_replace(m, r"(?i)^s(?=[0-9])", "Serie ")
    m = F.regexp_replace(m, r"\b[53]P\b", "5p")
    return x.withColumn(out, m).drop("_first")


def option_features(lines: DataFrame, vehicle: str, order_cols: list, text_col: str, colour_col: str,
                    flags: dict[str, Column], version_rules: list[tuple[Column, str]], colours: list[str],
                    rim_sizes=range(15, 21)) -> DataFrame:
    """CLS-07 / CLS-08: per vehicle, from all its option lines:
    boolean features (any line satisfies the test), the version (rules in
    order within a line, later lines override), the largest rim size present
    as a token, and the exterior colour = first vocabulary colour found in
    the first line's colour text ('undefined' when none)."""
    toks = F.split(F.col(text_col), " ")
    x = lines.withColumn("_tok", toks)
    cand = F.lit(None).cast("string")
    for cond, value in version_rules:
        cand = F.when(cond, F.lit(value)).otherwise(cand)
    rim = F.array_max(F.filter(F.transform(F.array(*[F.lit(str(s)) for s in rim_sizes]),
                                           lambda s: F.when(F.array_contains(F.col("_tok"), s), s.cast("int"))),
                               lambda v: v.isNotNull()))
    x = x.withColumn("_ver", cand).withColumn("_rim", rim)
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
    g = x.groupBy(vehicle).agg(
        *[F.max(c.cast("int")).cast("bigint").alias(n) for n, c in flags.items()],
        F.max_by("_ver", F.when(F.col("_ver").isNotNull(), order)).alias("version"),
        F.coalesce(F.max("_rim"), F.lit(0)).cast("bigint").alias("rims"),
        F.min_by(colour_col, order).alias("_colour_text"))
    ct = F.split(F.col("_colour_text"), " ")
    colour = F.lit(None).cast("string")
    for c in reversed(colours):
        colour = F.when(F.array_contains(ct, c), F.lit(c)).otherwise(colour)
    return g.withColumn("colour", F.coalesce(colour, F.lit("undefined"))).drop("_colour_text")


def ordered_when(base: Column, rules: list[tuple[Column, object]]) -> Column:
    """CLS-10: ordered rules, later rules win."""
    e = base
    for cond, value in rules:
        e = F.when(cond, F.lit(value)).otherwise(e)
    return e


def description_overrides(df: DataFrame, desc: str, exact: dict[str, str], partial: list[tuple[str, str]],
                          conditional: list[tuple[Column, str]], out: str = "desc_copy") -> DataFrame:
    """CLS-11: family from the description: exact whole-value replacements,
    then ordered regex replacements (each applied to the previous result),
    then conditional rules on the original description."""
    m = F.create_map(*[x for kv in exact.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    e = F.coalesce(F.element_at(m, F.col(desc)), F.col(desc))
    for pat, val in partial:
        e = F.regexp_replace(e, pat, val)
    for cond, val in conditional:
        e = F.when(cond, F.lit(val)).otherwise(e)
    return df.withColumn(out, e)


def family_replaces(df: DataFrame, col: str, drop: list[str], replace: dict[str, str], others: dict[str, str]) -> DataFrame:
    """CLS-12: drop listed families, then two value replacements."""
    x = df.filter(~F.col(col).isin(drop) | F.col(col).isNull())
    for mp in (replace, others):
        m = F.create_map(*[v for kv in mp.items() for v in (F.lit(kv[0]), F.lit(kv[1]))])
        x = x.withColumn(col, F.coalesce(F.element_at(m, F.col(col)), F.col(col)))
    return x
