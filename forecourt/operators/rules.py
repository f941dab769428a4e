"""Rule engines: keyword-rule labelling (RUL-*) and ordered classification
rules (CLS-*).  Rules are DataFrames (parameters), joined - never looped
over on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.clean import bounded_rows
from forecourt.session import materialize, small

UNDEFINED = "Não Definido"


#: Word rules of a table; they become expressions.
MOST_RULES = 10_000


def keyword_matches(requests: DataFrame, id_col: str, tokens_col: str, rules: DataFrame,
                    vocab: DataFrame | None = None, vocab_threshold: int | None = None) -> DataFrame:
    """RUL-01 / RUL-02 / RUL-03: (request, label, rule_id, rank) for every
    word rule that fires.  ``rules``: rule_id, label, kind in (single, all,
    consecutive), words array.  A rule only applies when all its words are in
    the vocabulary (top words): either a given ``vocab`` table or the tokens
    found in more than ``vocab_threshold`` requests.  'all' = every word
    anywhere; 'consecutive' additionally needs 1 + (number of adjacent hits of
    consecutive rule words) >= number of words (Q-08 count rule).

    A request's tokens are read once, in place: what leaves its row are the rule
    words it holds and the hits of adjacent rule words, which are stored, so the work
    past the scan follows the rule hits, not the text volume."""
    wr = rules.filter(F.col("kind").isin("single", "all", "consecutive"))
    given = bounded_rows(wr.select("rule_id", "kind", "words"), MOST_RULES)
    words = sorted({w for r in given for w in r["words"] if w is not None})
    pairs = [(r["rule_id"], *p) for r in given if r["kind"] == "consecutive" for p in zip(r["words"], r["words"][1:]) if None not in p]
    seen = _rule_hits(requests, id_col, tokens_col, words, pairs)
    rt = seen.select(id_col, F.explode("_words").alias("tok"))
    if vocab_threshold is not None:
        vocab = rt.groupBy("tok").agg(F.count(F.lit(1)).alias("_df")).filter(F.col("_df") > vocab_threshold) \
                  .select(F.col("tok").alias("word"))
    if vocab is not None:
        ok = (wr.select("rule_id", F.explode(F.array_distinct("words")).alias("tok"))
                .join(vocab.select(F.col("word").alias("tok")), "tok", "left_semi")
                .groupBy("rule_id").agg(F.count(F.lit(1)).alias("_k")))
        wr = wr.join(ok, "rule_id").filter(F.col("_k") == F.size(F.array_distinct("words"))).drop("_k")
    rw = wr.select("rule_id", "label", "kind", F.size(F.array_distinct("words")).alias("_nd"),
                   F.explode(F.array_distinct("words")).alias("tok"))
    present = (rt.join(small(rw), "tok").groupBy(id_col, "rule_id", "label", "kind", "_nd")
                 .agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") == F.col("_nd")))
    hits = (seen.select(id_col, F.explode("_hits").alias("_h")).groupBy(id_col, F.col("_h.rule_id").alias("rule_id"))
                .agg(F.sum("_h.n").alias("_hits")))
    nwords = wr.filter(F.col("kind") == "consecutive").select("rule_id", F.size("words").alias("_nw"))
    m = present.join(hits, [id_col, "rule_id"], "left").join(nwords, "rule_id", "left")
    m = m.filter((F.col("kind") != "consecutive") | (1 + F.coalesce(F.col("_hits"), F.lit(0)) >= F.col("_nw")))
    rank = F.when(F.col("kind") == "single", 0).when(F.col("kind") == "all", 1).otherwise(2)
    return m.select(id_col, "label", "rule_id", rank.alias("rank"))


def _rule_hits(requests: DataFrame, id_col: str, tokens_col: str, words: list[str], pairs: list[tuple]) -> DataFrame:
    """(id, _words: the distinct rule words of the request's rows, _hits: (rule_id, n) of each adjacent
    pair of rule words met n times in a row), stored."""
    held = F.array_distinct(F.filter(tokens_col, lambda t: t.isin(words))) if words else F.array().cast("array<string>")
    kind = "array<struct<rule_id:bigint,n:bigint>>"
    if pairs:
        first = sorted({p[1] for p in pairs})
        at = F.transform(tokens_col, lambda t, i: F.when(t.isin(first), F.struct(t.alias("a"), F.get(tokens_col, i + 1).alias("b"))))
        near = requests.select(id_col, held.alias("_w"), F.filter(at, lambda x: x.isNotNull()).alias("_at"))

        def count(rule: int, a: str, b: str) -> Column:
            return F.struct(F.lit(rule).cast("bigint").alias("rule_id"), F.size(F.filter("_at", lambda x: (x["a"] == a) & (x["b"] == b))).cast("bigint").alias("n"))
        met = F.filter(F.array(*[count(*p) for p in pairs]), lambda h: h["n"] > 0)
        near = near.select(id_col, "_w", F.when(F.size("_at") > 0, met).otherwise(F.array()).cast(kind).alias("_h"))
    else:
        near = requests.select(id_col, held.alias("_w"), F.array().cast(kind).alias("_h"))
    near = near.filter(F.size("_w") > 0)
    return materialize(near.groupBy(id_col).agg(F.array_distinct(F.flatten(F.collect_list("_w"))).alias("_words"), F.flatten(F.collect_list("_h")).alias("_hits")), "checkpoint")


def resolve_draws(requests: DataFrame, id_col: str, matches: DataFrame, label_rank: DataFrame,
                  undefined: str = UNDEFINED) -> DataFrame:
    """RUL-04: several labels -> the highest-ranked label when the matched
    labels' ranks differ (ties: first matched), else 'Draw: a+b' listing all
    matches in rule order; one label -> it; none -> undefined."""
    lr = label_rank.select("label", F.col("rank").alias("_lrank"))
    per_label = (matches.groupBy(id_col, "label").agg(F.min("rule_id").alias("_first"))
                        .join(lr, "label", "left"))
    lab = per_label.groupBy(id_col).agg(
        F.count_distinct("label").alias("_ul"), F.count_distinct("_lrank").alias("_ur"),
        F.max_by("label", F.when(F.col("_lrank").isNotNull(), F.struct("_lrank", (-F.col("_first")).alias("f")))).alias("_winner"))
    allm = matches.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_m"), F.min_by("label", "rule_id").alias("_firstlabel"),
        F.sort_array(F.collect_list(F.struct("rule_id", "label"))).alias("_all"))
    r = lab.join(allm, id_col)
    draw = F.concat(F.lit("Draw: "), F.array_join(F.transform("_all", lambda s: s["label"]), "+"))
    label = (F.when((F.col("_m") > 1) & (F.col("_ul") > 1),
                    F.when(F.col("_ur") > 1, F.col("_winner")).otherwise(draw))
              .otherwise(F.col("_firstlabel")))
    res = r.select(id_col, label.alias("_resolved"))
    return (requests.select(id_col).join(res, id_col, "left")
                    .select(id_col, F.coalesce("_resolved", F.lit(undefined)).alias("label")))


def forced_labels(requests: DataFrame, id_col: str, text_col: str, rules: DataFrame) -> DataFrame:
    """RUL-06: regex found in the text -> label; the last rule wins.  The
    rule table is a bounded parameter and becomes one expression."""
    forced = bounded_rows(rules.filter(F.col("kind") == "forced").select("rule_id", "label", "pattern"))
    last_first = sorted(forced, key=lambda r: r.rule_id, reverse=True)
    hit = [F.when(F.col(text_col).rlike(r.pattern), F.struct(F.lit(r.rule_id).cast("bigint").alias("rule_id"), F.lit(r.label).alias("label")))
           for r in last_first]
    none = F.lit(None).cast("struct<rule_id:bigint,label:string>")
    found = requests.select(id_col, F.coalesce(*hit, none).alias("_f")).where(F.col("_f").isNotNull())
    return found.groupBy(id_col).agg(F.max("_f")["label"].alias("forced_label"))


def user_labels(requests: DataFrame, id_col: str, customer_col: str, rules: DataFrame) -> DataFrame:
    """RUL-05: customer id -> label; the last rule wins."""
    ur = rules.filter(F.col("kind") == "user").select("rule_id", "label", F.col("user_id").alias(customer_col))
    j = requests.select(id_col, customer_col).join(ur, customer_col)
    return j.groupBy(id_col).agg(F.max_by("label", "rule_id").alias("user_label"))


def label_requests(requests: DataFrame, id_col: str, tokens_col: str, text_col: str, customer_col: str,
                   rules: DataFrame, label_rank: DataFrame, vocab: DataFrame | None = None,
                   manual: DataFrame | None = None, undefined: str = UNDEFINED,
                   vocab_threshold: int | None = None, words: DataFrame | None = None) -> DataFrame:
    """RUL-01 end to end: word rules and draw resolution, then forced rules,
    then user rules, then manual labels (first per request) override.
    ``words`` holds the requests' tokens, if ``requests`` does not."""
    m = keyword_matches(requests if words is None else words, id_col, tokens_col, rules, vocab, vocab_threshold)
    base = resolve_draws(requests, id_col, m, label_rank, undefined)
    out = (base.join(forced_labels(requests, id_col, text_col, rules), id_col, "left")
               .join(user_labels(requests, id_col, customer_col, rules), id_col, "left"))
    cols = [F.col("user_label"), F.col("forced_label"), F.col("label")]
    if manual is not None:
        mm = manual.groupBy(id_col).agg(F.min_by("manual_label", "manual_order").alias("manual_label"))
        out = out.join(mm, id_col, "left")
        cols = [F.col("manual_label")] + cols
    return out.select(id_col, F.coalesce(*cols).alias("label"))


def undefined_share(labels: DataFrame, id_col: str, undefined: str = UNDEFINED) -> DataFrame:
    """RUL-07: percent of requests left undefined."""
    return labels.agg((F.sum((F.col("label") == undefined).cast("int")) / F.count_distinct(id_col) * 100)
                      .alias("undefined_pct"))


def apply_ordered_rules(df: DataFrame, text_col: str, rules: DataFrame, out: str,
                        default: Column | None = None, extra_cond=None) -> DataFrame:
    """Ordered-rule helper (CLS-11, RUL-09): rules (rule_id, match, value,
    kind in exact | regex | starts | contains); the highest rule_id that
    matches wins (later rules overwrite earlier ones).  ``extra_cond`` makes a
    further condition from a rule's row.  The rule table is a bounded parameter
    and becomes one expression per row: no join, no shuffle."""
    text = F.col(text_col)
    kinds = {"exact": lambda m: text == m, "regex": text.rlike, "starts": text.startswith, "contains": text.contains}
    branches = []
    for r in sorted(bounded_rows(rules), key=lambda x: x["rule_id"], reverse=True):
        cond = kinds[r["kind"]](r["match"])
        branches.append(F.when(cond if extra_cond is None else cond & extra_cond(r), F.lit(r["value"])))
    return df.withColumn(out, F.coalesce(*branches, default if default is not None else F.lit(None).cast("string")))
