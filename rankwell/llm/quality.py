"""Quality rules as a short-circuit cascade of DataFrame expressions.

Every rule is an expression over a text. On a sample each rule is timed and its rejections are
counted; the rules then run in the order of rejections per second, each one only on what the
ones before it let through. The order never changes which documents are kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import fresh, stored

# Rows on which costs and rejections are estimated, about.
SAMPLE_ROWS = 1000
_SPACE, _SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]+"

# Limits of the rules. The first two.
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
MAX_SYMBOLS_PERCENT, MAX_DUP_LINES_PERCENT = 10, 50
MIN_WORD_CHARS, MAX_WORD_CHARS, MIN_LETTER_WORDS_PERCENT = 2, 15, 60


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_symbols(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return (F.length(whole) - F.length(F.regexp_replace(whole, _SYMBOLS, ""))).cast("long")


def n_dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in ``words``.

    Windows are compared by a 64-bit hash of their words. Texts without an equal pair are told
    by a hash set; only the others sort their windows, and equal neighbours give the places.
    """

    def of(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        return let(F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))), repeated)

    def repeated(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(pairs, covered))

    def covered(pairs: Column) -> Column:
        def again(pair: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(pairs, j - 1)["h"])
            return F.coalesce(pair["h"] == before, F.lit(False)) | F.coalesce(pair["h"] == F.get(pairs, j + 1)["h"], F.lit(False))

        return let(F.sort_array(F.transform(F.filter(pairs, again), lambda p: p["i"])), spread)

    def spread(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - s, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return let(words, lambda w: F.when(F.size(w) < 4, 0).otherwise(of(w))).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps a text and its words to whether the rule rejects it.

    ``by`` tells the same from the columns that ``measured`` adds, where those are enough.
    """

    name: str
    rejects: Callable[[Column, Column], Column]
    by: str | None = None


def _repeats(text: Column, words: Column) -> Column:
    return 100 * n_repeat_words(words) > MAX_REPEATED_PERCENT * F.size(words)


def _repeated_lines(text: Column, words: Column) -> Column:
    return let(_lines(text), lambda lines: 100 * n_dup_lines(lines) > MAX_DUP_LINES_PERCENT * F.size(lines))


def _word_length(text: Column, words: Column) -> Column:
    chars, n = F.length(F.array_join(words, "")), F.size(words)
    return (chars < MIN_WORD_CHARS * n) | (chars > MAX_WORD_CHARS * n)


def _few_letters(text: Column, words: Column) -> Column:
    lettered = F.size(F.filter(words, lambda w: w.rlike(r"\p{L}")))
    return 100 * lettered < MIN_LETTER_WORDS_PERCENT * F.size(words)


RULES = (
    Rule("short", lambda text, words: F.size(words) < MIN_WORDS, f"n_words < {MIN_WORDS}"),
    Rule("repeats", _repeats, f"100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"),
    Rule(
        "symbols",
        lambda text, words: 100 * n_symbols(text) > MAX_SYMBOLS_PERCENT * F.size(words),
        f"100 * n_symbols > {MAX_SYMBOLS_PERCENT} * n_words",
    ),
    Rule("repeated_lines", _repeated_lines, f"100 * n_dup_lines > {MAX_DUP_LINES_PERCENT} * n_lines"),
    Rule(
        "word_length", _word_length, f"word_chars < {MIN_WORD_CHARS} * n_words or word_chars > {MAX_WORD_CHARS} * n_words"
    ),
    Rule("few_letters", _few_letters),
)


def estimates(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[tuple[str, float, int]]:
    """(rule, seconds, rejected) on a sample of about ``rows`` rows with a fixed seed.

    The seconds are those above what splitting the sample into words takes: the best of three
    runs, after one that compiles the rule.
    """
    chosen = docs.select(F.col(f"`{text}`").alias("text"))
    total = chosen.count()
    sample = stored(chosen.sample(fraction=min(1.0, rows / max(1, total)), seed=7)).coalesce(1)

    def run(rule: Callable[[Column, Column], Column]) -> tuple[float, int]:
        rejected = let(words_of(F.col("text")), lambda w: rule(F.col("text"), w))
        counted = sample.agg(F.sum(rejected.cast("long")))
        n, seconds = counted.first()[0], []
        for _ in range(3):
            began = time.perf_counter()
            counted.first()
            seconds.append(time.perf_counter() - began)
        return min(seconds), n or 0

    def none(text: Column, words: Column) -> Column:
        return F.size(words) < 0

    least, _ = run(none)
    timed = [(rule.name, *run(rule.rejects)) for rule in rules]
    return [(name, max(seconds - least, 1e-3), n) for name, seconds, n in timed]


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by falling rejections per second on a sample; ties by their given order."""
    rate = {name: n / seconds for name, seconds, n in estimates(docs, rules, text, rows)}
    return sorted(rules, key=lambda rule: -rate[rule.name])


def rejected_by(text: Column, rules: Sequence[Rule]) -> Column:
    """The first rule that rejects a text, else null; a rule runs only if none before it rejects."""

    def cascade(words: Column) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(rules):
            out = F.when(rule.rejects(text, words), rule.name).otherwise(out)
        return out

    return let(words_of(text), cascade)


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with rejected_by (null for kept rows); an input column of that name is replaced.

    Null and empty texts have no words. ``rules`` run as given, by default in the order found on
    a sample of ``docs``. With several rejecting rules the order decides which is named.
    """
    rules = ordered(docs, text=text) if rules is None else rules
    return docs.withColumn("rejected_by", rejected_by(docs[f"`{text}`"], rules))


def judge_measured(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """``docs``, as ``measured`` returns them, with rejected_by like ``judge``.

    Rules read the measured columns where those tell enough; only the others look at the text
    again, after all that come before them. By default rules that read columns come first, each of
    the two kinds in the order found on a sample.
    """
    if rules is None:
        rules = ordered(docs, text=text)
        rules = [*[r for r in rules if r.by], *[r for r in rules if not r.by]]
    whole = docs[f"`{text}`"]

    def by_text(rule: Rule) -> Column:
        return let(words_of(whole), lambda words: rule.rejects(whole, words))

    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(F.expr(rule.by) if rule.by else by_text(rule), rule.name).otherwise(out)
    return docs.withColumn("rejected_by", out)


def keep(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, columns as they were."""
    rules = ordered(docs, text=text) if rules is None else rules
    return docs.filter(rejected_by(docs[f"`{text}`"], rules).isNull())


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words and base_failed.

    ``base_failed``: fewer than MIN_WORDS words, or more than MAX_REPEATED_PERCENT of them in
    repeated windows. Null texts count as empty; input columns of these names are replaced.
    """
    whole, name = docs[f"`{text}`"], fresh(docs, "__measures")

    def measures(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            n_symbols(whole).alias("n_symbols"),
            let(_lines(whole), lambda lines: F.struct(n_dup_lines(lines).alias("dup"), F.size(lines).cast("long").alias("n"))).alias("lines"),
            n_repeat_words(w).alias("n_repeat_words"),
        )

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]
    places = {"n_dup_lines": "lines.dup", "n_lines": "lines.n"}
    held = docs.withColumn(name, let(words_of(whole), measures))
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in {*names, "base_failed"}]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return held.select(*kept, *[F.col(f"{name}.{places.get(n, n)}").alias(n) for n in names]).withColumn("base_failed", failed)


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
grams AS (SELECT doc_id, list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS g
          FROM w WHERE len(ws) > 2),
g AS (SELECT doc_id, unnest(g) AS g, unnest(range(1, len(g) + 1)) AS i FROM grams),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again CROSS JOIN (VALUES (0), (1), (2)) v(k) GROUP BY 1),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_lettered
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > {MAX_SYMBOLS_PERCENT} * n_words
            OR 100 * n_dup_lines > {MAX_DUP_LINES_PERCENT} * n_lines
            OR word_chars < {MIN_WORD_CHARS} * n_words OR word_chars > {MAX_WORD_CHARS} * n_words
            OR 100 * n_lettered < {MIN_LETTER_WORDS_PERCENT} * n_words) AS kept
FROM b
"""
