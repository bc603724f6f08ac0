"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Every rule is a row of ``RULES``: a measure, the bounds outside which a text fails, and the number of
words from which the rule applies. ``compile_rules`` turns rows and measures into Column expressions,
so the whole operator is one map-side projection: no shuffle, no Python, nothing that grows but the
text in hand.

Defined cases: a null text counts as empty; an empty text has no words, fails the length rule and is
not kept; repeated rows and ids are judged each for itself, so there are no ties; a text is judged whole,
as long as its words fit an array of the row in hand; null ids stay null; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlog.llm import common

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

#: Very common words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from have in is it not of on or that the this to was were which with "
    "als auf aus bei das dem den der des die ein eine für im in ist mit nicht sich sie und von war zu "
    "au aux avec ce dans de des du elle en est et il la le les ne pas par pour que qui se sur un une "
    "al como con de del el en es la las lo los no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high]; texts under ``from_words`` words are not asked."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The thresholds. The first two are the base that every text must meet.
RULES = (
    Rule("too_short", "n_words", low=20),
    Rule("repeats_itself", "repeat_ratio", high=0.30),
    Rule("symbols", "symbols_per_word", high=0.20),
    Rule("stop_words", "stop_ratio", low=0.02, from_words=50),
    Rule("dup_lines", "dup_line_ratio", high=0.50),
    Rule("word_length", "mean_word_chars", low=2.0, high=16.0),
    Rule("capitals", "upper_ratio", high=0.50),
)


def _repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a ``width``-word window found at least twice in the text.

    Windows are compared by a 64-bit hash. Only a text whose hashes are not distinct sorts them.
    """
    last = F.size(words) - width

    def covered(sorted_windows: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            here = x["h"]
            before = (k > 0) & (sorted_windows[F.greatest(k - 1, F.lit(0))]["h"] == here)
            after = (k < last) & (sorted_windows[F.least(k + 1, last)]["h"] == here)
            return before | after

        starts = F.sort_array(F.transform(F.filter(sorted_windows, twice), lambda x: x["i"]))
        add = F.aggregate(
            starts,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).alias("at")),
            lambda s, i: F.struct((s["n"] + F.least(F.lit(width), i - s["at"])).alias("n"), i.alias("at")),
        )
        return add["n"]

    def of(hashes: Column) -> Column:
        indexed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(common.let(F.sort_array(indexed), covered))

    def doubled(hashes: Column, step: int) -> Column:
        # The hash of 2 * step words from those of step words here and step words on.
        return common.let(hashes, lambda x: F.transform(x, lambda h, i: F.xxhash64(h, F.get(x, i + step))))

    hashes, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < width:  # a power of two
        hashes, step = doubled(hashes, step), 2 * step
    hashes = F.slice(hashes, F.lit(1), last + 1)
    return F.when(last < 1, F.lit(0).cast("long")).otherwise(common.let(hashes, of))


def measures(text: Column) -> Column:
    """A struct of all counts of one text; every array lives only inside the expression."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.when(text.rlike(SYMBOLS), F.length(F.regexp_replace(text, SYMBOLS.replace("[", "[^") + "+", ""))).otherwise(0).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_upper"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return common.let(common.word_list(text), lambda w: common.let(lines, lambda x: of(w, x)))


def compile_rules(rules: tuple[Rule, ...], m: Column) -> tuple[Column, Column]:
    """(array of the names of the broken rules, true if none is)."""
    n = F.greatest(m["n_words"], F.lit(1))
    known = {
        "n_words": m["n_words"],
        "repeat_ratio": m["n_repeat_words"] / n,
        "symbols_per_word": m["n_symbols"] / n,
        "stop_ratio": m["n_stop_words"] / n,
        "dup_line_ratio": m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
        "mean_word_chars": m["word_chars"] / n,
        "upper_ratio": m["n_upper"] / F.greatest(m["word_chars"], F.lit(1)),
    }
    broken = []
    for r in rules:
        x, out = known[r.measure], F.lit(False)
        if r.low is not None:
            out = out | (x < r.low)
        if r.high is not None:
            out = out | (x > r.high)
        broken.append(F.when(out & (m["n_words"] >= r.from_words), F.lit(r.name)))
    names = F.array_compact(F.array(*broken))
    return names, F.size(names) == 0


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the counts, base_failed, broken_rules and kept."""
    m = F.col("m")
    judged = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    base = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    names, fine = compile_rules(rules, m)
    return judged.select(
        "doc_id",
        *(m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper")),
        base.alias("base_failed"),
        names.alias("broken_rules"),
        (~base & fine).alias("kept"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(common.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper", "base_failed", "kept")


_STOP_SQL = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
ORACLE_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT rid, i, array_to_string(words[i + 1:i + 8], chr(10)) AS g
        FROM (SELECT rid, words, unnest(range(0, len(words) - 7)) AS i FROM w WHERE len(words) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, sum(least(8, i - prev)) AS n FROM
        (SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -8) AS prev FROM dup) GROUP BY rid),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(list_filter(words, lambda x: lower(x) IN ({_STOP_SQL}))) AS BIGINT) AS n_stop_words,
        CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, greatest(n_words, 1) AS n FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_upper, base_failed,
  NOT (base_failed OR n_repeat_words / n > 0.30 OR n_symbols / n > 0.20 OR (n_words >= 50 AND n_stop_words / n < 0.02)
       OR n_dup_lines / greatest(n_lines, 1) > 0.50 OR word_chars / n < 2.0 OR word_chars / n > 16.0
       OR n_upper / greatest(word_chars, 1) > 0.50) AS kept
FROM b
"""
