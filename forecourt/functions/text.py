"""Text functions (STR-*): column expressions on the JVM side, plus the one
vocabulary-level Python helper (the Porter stemmer), applied to DISTINCT
tokens only and joined back."""

from __future__ import annotations

import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from forecourt.session import stored_small

WS_TRIM = r"^[\s]+|[\s]+$"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _accent_table() -> tuple[str, str]:
    """Latin letters with diacritics -> base letter, built from the Unicode
    decomposition of U+00C0..U+024F (single-character mappings only)."""
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


ACCENT_SRC, ACCENT_DST = _accent_table()


def strip_accents(c) -> Column:
    """STR-06: accent removal."""
    return F.translate(_c(c), ACCENT_SRC, ACCENT_DST)


def punct_to_space(c, trim: bool = True) -> Column:
    """STR-07: ASCII punctuation to a space, then whitespace-trimmed
    (the untrimmed twin with ``trim=False``)."""
    e = F.regexp_replace(_c(c), r"\p{Punct}", " ")
    return F.regexp_replace(e, WS_TRIM, "") if trim else e


def digits_out(c) -> Column:
    """STR-08."""
    return F.regexp_replace(_c(c), "[0-9]", "")


def regex_replace(c, pattern: str, replacement: str = "") -> Column:
    """STR-01."""
    return F.regexp_replace(_c(c), pattern, replacement)


def remove_prefix_codes(c, codes: list[str]) -> Column:
    """STR-02: remove any of the codes at the start, longest first (so a
    code that is a prefix of another one never wins)."""
    alts = "|".join(sorted(codes, key=lambda s: (-len(s), s)))
    return F.regexp_replace(_c(c), f"^(?:{alts})", "")


def reorder_reference(c) -> Column:
    """STR-03: characters 4-9, then 1-3, then the rest."""
    s = _c(c)
    return F.concat(F.substring(s, 4, 6), F.substring(s, 1, 3), F.substring(s, 10, 1 << 20))


def regex_extract_default(c, pattern: str, default=None) -> Column:
    """STR-05: capture group 1, empty match -> default."""
    e = F.regexp_extract(_c(c), pattern, 1)
    return F.coalesce(F.nullif(e, F.lit("")), F.lit(default))


def ws_tokens(c) -> Column:
    """Whitespace tokenisation (Q-21) of already cleaned text."""
    return F.filter(F.split(_c(c), r"\s+"), lambda t: t != "")


QUOTE_TOKENS = ["''", "``", "“", "”", "'", ","]


PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DIGITS = "0123456789"


def request_text_tokens(c) -> Column:
    """STR-13 (before stemming): lower case, digits out, punctuation to
    space, accents out, whitespace tokens, quote tokens dropped.  The three
    character-level steps touch disjoint character sets, so they run as ONE
    ``translate`` pass (characters beyond the target string are deleted)."""
    src = PUNCT + ACCENT_SRC + DIGITS
    dst = " " * len(PUNCT) + ACCENT_DST
    t = F.translate(F.lower(_c(c)), src, dst)
    return F.filter(ws_tokens(t), lambda x: ~x.isin(QUOTE_TOKENS))


def remove_words(tokens: Column, words: list[str]) -> Column:
    """STR-09 for a bounded list (literal array)."""
    arr = F.array(*[F.lit(w) for w in words])
    return F.filter(tokens, lambda t: ~F.array_contains(arr, t))


def expand_abbreviations(tokens: Column, mapping: dict[str, str]) -> Column:
    """STR-10: token -> expansion where listed (bounded map literal)."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.transform(tokens, lambda t: F.coalesce(F.element_at(m, t), t))


def shape_counts(c) -> list[Column]:
    """STR-18: length, words, digits, letters, spaces and other characters."""
    s = _c(c)
    n = F.length(s)
    digits = n - F.length(F.regexp_replace(s, "[0-9]", ""))
    letters = n - F.length(F.regexp_replace(s, r"\p{L}", ""))
    spaces = n - F.length(F.regexp_replace(s, " ", ""))
    return [n.alias("n_chars"), F.size(ws_tokens(s)).alias("n_words"), digits.alias("n_digits"),
            letters.alias("n_letters"), spaces.alias("n_spaces"), (n - digits - letters - spaces).alias("n_other")]


def all_words_pattern(c, include: list[str], exclude: list[str] = ()) -> Column:
    """STR-20 / STR-21: every include word present (any order, word
    boundaries, case-insensitive) and no exclude word."""
    cond = F.lit(True)
    for w in include:
        cond = cond & _c(c).rlike(rf"(?i)\b{w}\b")
    for w in exclude:
        cond = cond & ~_c(c).rlike(rf"(?i)\b{w}\b")
    return cond


def text_match(c, text: str, option: str) -> Column:
    """STR-22: 'starts' / 'contains' (all words, STR-21) / 'equals'."""
    if option == "starts":
        return F.lower(_c(c)).startswith(text.lower())
    if option == "equals":
        return F.lower(_c(c)) == text.lower()
    return all_words_pattern(c, text.split())


def word_canon(c, variants: dict[str, list[str]], when: Column | None = None) -> Column:
    """STR-14: sequential canonicalisation of spelling variants (word
    bounded), optionally only where ``when`` holds (e.g. one language)."""
    e = _c(c)
    for canonical, alts in variants.items():
        pat = r"\b" + r"\b|\b".join(sorted(alts)) + r"\b"
        rep = F.regexp_replace(e, pat, canonical)
        e = rep if when is None else F.when(when, rep).otherwise(e)
    return e


# ---------------------------------------------------------------- stemming
# Porter (1980) suffix stripping, applied to the distinct vocabulary only.

def _cons(w, i):
    ch = w[i]
    if ch in "aeiou":
        return False
    if ch == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(stem):
    n, i, L = 0, 0, len(stem)
    while i < L and _cons(stem, i):
        i += 1
    while i < L:
        while i < L and not _cons(stem, i):
            i += 1
        if i >= L:
            break
        n += 1
        while i < L and _cons(stem, i):
            i += 1
    return n


def _has_vowel(stem):
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_c(w):
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w):
    if len(w) < 3:
        return False
    return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
            and w[-1] not in "wxy")


_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
          ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
          ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
          "ism", "ate", "iti", "ous", "ive", "ize"]


def porter_stem(w: str) -> str:
    if w is None or len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    flag = False
    if w.endswith("eed"):
        if _m(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, flag = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, flag = w[:-3], True
    if flag:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_c(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _m(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # step 2 / 3
    for table in (_STEP2, _STEP3):
        for suf, rep in table:
            if w.endswith(suf):
                if _m(w[:-len(suf)]) > 0:
                    w = w[:-len(suf)] + rep
                break
    # step 4
    for suf in _STEP4:
        if w.endswith(suf):
            stem = w[:-len(suf)]
            if _m(stem) > 1 and (suf != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    # step 5
    if w.endswith("e"):
        stem = w[:-1]
        if _m(stem) > 1 or (_m(stem) == 1 and not _cvc(stem)):
            w = stem
    if _m(w) > 1 and _double_c(w) and w.endswith("l"):
        w = w[:-1]
    return w


@pandas_udf(StringType())
def _stem_udf(words: pd.Series) -> pd.Series:
    return words.map(porter_stem)


def stem_table(tokens_df: DataFrame, token_col: str = "word") -> DataFrame:
    """STR-11: (word, stem) for the DISTINCT vocabulary - the Python work is
    proportional to the vocabulary, not to the text volume."""
    vocab = tokens_df.select(F.col(token_col).alias("word")).where(F.col("word").isNotNull()).distinct()
    return vocab.withColumn("stem", _stem_udf(F.col("word")))


#: Texts whose new tokens a task holds at once.
TEXTS = 500


def _replaced(min_len: int):
    """Arrow function: a key's token lists, with the words that change and what they become."""
    def run(lists: pa.Array, words: pa.Array, stems: pa.Array) -> pa.Array:
        out = []
        for a in range(0, len(lists), TEXTS):
            rows = []
            for own, word, stem in zip(*(x.slice(a, TEXTS) for x in (lists, words, stems))):
                known, own = dict(zip(word.as_py() or (), stem.as_py() or ())), own.as_py() or []
                if len(own) == 1:
                    new = [s for t in own[0] for s in known.get(t, (t,))]
                else:  # rows of one key are one text, position by position
                    at = sorted(((i, s) for tokens in own for i, t in enumerate(tokens) for s in known.get(t, (t,))), key=lambda x: (x[0], x[1] is not None, x[1] or ""))
                    new = [s for _, s in at]
                rows.append([s for s in new if s is not None and len(s) >= min_len] if min_len else new)
            out.append(pa.array(rows, pa.list_(pa.string())))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.string()))
    # The annotations name the kind of function and are read as objects.
    run.__annotations__ = {"lists": pa.Array, "words": pa.Array, "stems": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<string>")


def apply_word_table(df: DataFrame, id_col: str, tokens_col: str, table: DataFrame,
                     out: str, min_len: int = 0) -> DataFrame:
    """Map every token through a (word, stem) table keeping token order.
    The distinct words of a text meet the words that the table changes, and those
    few are gathered per id, beside the tokens, which are mapped in place; so a
    token is no row.  Tokens shorter than ``min_len`` after mapping are dropped.
    Up to 100,000 changed words are broadcast, so a very common word is not one task."""
    stem = F.sort_array(F.collect_list(F.coalesce("stem", "word")))
    changed = table.where(F.col("word").isNotNull()).groupBy("word").agg(stem.alias("stems")).where(F.col("stems") != F.array("word"))
    known = df.select(id_col, F.explode(F.array_distinct(tokens_col)).alias("word")).join(stored_small(changed), "word")
    known = known.groupBy(id_col).agg(F.collect_list(F.struct("word", "stems")).alias("_k"))
    lists = df.where(F.col(tokens_col).isNotNull()).groupBy(id_col).agg(F.collect_list(tokens_col).alias("_l")).join(known, id_col, "left")
    back = lists.select(id_col, _replaced(min_len)("_l", F.col("_k.word"), F.col("_k.stems")).alias(out))
    return df.join(back, id_col, "left").withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>")))
