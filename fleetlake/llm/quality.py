"""Quality rules as a cascade that stops at the first rejection.

The words of a text are made once and all rules read them. A sample tells what each rule
costs and how much it rejects; the cascade asks first the rules that reject most for
their cost. The order changes the work, never the verdict: a text is kept where no rule
rejects it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SAMPLE_ROWS = 500
_BLANK = r"[\\x20\\x09-\\x0D]"

# Measures in SQL over `w`, the words, and `t`, the text.
_LINES = rf"filter(split(t, '\\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"
_HASHED = (
    "transform(array(transform(w, x -> xxhash64(x))), h -> "
    "transform(sequence(0, size(h) - 5), i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4])))[0]"
)
# Windows sorted by hash stand beside their equals; their places, sorted again, are a union of spans of five.
_COVERED = """aggregate(
    array_sort(transform(
        filter(sequence(0, size(s) - 1), k -> (k > 0 AND s[k].h = s[greatest(k - 1, 0)].h)
            OR (k < size(s) - 1 AND s[k].h = s[least(k + 1, size(s) - 1)].h)),
        k -> s[k].i)),
    named_struct('n', 0L, 'last', -5),
    (a, x) -> named_struct('n', a.n + least(5, x - a.last), 'last', x), a -> a.n)"""
_REPEATED = f"""CASE WHEN size(w) < 5 THEN 0L ELSE transform(array({_HASHED}), g ->
    CASE WHEN size(array_distinct(g)) = size(g) THEN 0L ELSE transform(
        array(array_sort(transform(g, (x, i) -> named_struct('h', x, 'i', i)))), s -> {_COVERED})[0] END)[0] END"""

MEASURES = {
    "n_words": "CAST(size(w) AS BIGINT)",
    "word_chars": "aggregate(w, 0L, (a, x) -> a + length(x))",
    "n_symbols": "CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '')) AS BIGINT)",
    "n_lines": f"CAST(size({_LINES}) AS BIGINT)",
    "n_dup_lines": f"CAST(transform(array({_LINES}), l -> size(l) - size(array_distinct(l)))[0] AS BIGINT)",
    "n_repeat_words": _REPEATED,
}


@dataclass(frozen=True)
class Rule:
    """A rule rejects where `rejects`, SQL over names of measures in braces, is true."""

    name: str
    rejects: str


BASE_RULES = (
    Rule("few_words", "{n_words} < 10"),
    Rule("repeated_words", "100 * {n_repeat_words} > 20 * {n_words}"),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", "10 * {n_symbols} > {n_words}"),
    Rule("word_length", "{word_chars} < 2 * {n_words} OR {word_chars} > 15 * {n_words}"),
    # a share of lines says little where there are few
    Rule("repeated_lines", "{n_dup_lines} > 2 AND 10 * {n_dup_lines} > 3 * {n_lines}"),
)


def _over_text(text: str, body: str) -> Column:
    """`body` over t and w, each evaluated once."""
    words = rf"filter(split(t, '{_BLANK}+'), x -> x <> '')"
    return F.expr(f"transform(array(coalesce({text}, '')), t -> transform(array({words}), w -> {body})[0])[0]")


def measure(text: str, names: tuple[str, ...] = tuple(MEASURES)) -> Column:
    """Struct of the named measures of the column `text`; a null text counts as empty."""
    return _over_text(text, "named_struct(" + ", ".join(f"'{n}', {MEASURES[n]}" for n in names) + ")")


def _case(rules: tuple[Rule, ...], values: dict[str, str]) -> str:
    tests = [f"WHEN {r.rejects.format(**values)} THEN '{r.name}'" for r in rules]
    return f"CASE {' '.join(tests)} END" if tests else "CAST(NULL AS STRING)"


def rejected_by(text: str, rules: tuple[Rule, ...]) -> Column:
    """Name of the first rule, in the given order, that rejects the text; null where it is kept."""
    return _over_text(text, _case(rules, MEASURES))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text", rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by rejections per second on a sample of at most `rows` rows, spread over the table.

    Every row has the same chance, one that leaves little more than `rows` in all, so that what
    meets to be limited does not grow with the table. Only the order comes from the sample, no
    threshold. Without rows the order stays.
    """
    chance = min(1.0, (1.2 * rows + 100) / max(docs.count(), 1))
    sample = stored(docs.select(F.col(text_column).alias("text")).sample(chance, seed=7).limit(rows))

    def run(rule: Rule) -> tuple[float, int]:
        started = time.perf_counter()
        rejected = sample.agg(F.count(rejected_by("text", (rule,)))).first()[0]
        return time.perf_counter() - started, rejected

    idle = Rule("idle", "{n_words} < 0")
    run(idle)  # compiles what all rules share
    nothing = min(run(idle)[0] for _ in range(2))
    scored = []
    for rule in rules:
        run(rule)
        cost, rejected = run(rule)
        scored.append((-rejected / max(cost - nothing, 1e-3), rule))
    return tuple(rule for _, rule in sorted(scored, key=lambda pair: pair[0]))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns; the rules run as a cascade."""
    return docs.where(rejected_by(f"`{text_column}`", order_rules(docs, rules, text_column)).isNull())


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, the measures, base_failed and kept.

    The cascade reads the measures, which the result shows in any case. A null text
    counts as empty and fails for its few words; ids may be null or repeated; other
    columns are ignored and an empty table gives no rows.
    """
    ordered = order_rules(docs, rules, text_column)
    names = {n: f"m.{n}" for n in MEASURES}
    measured = docs.select(F.col(id_column).alias("doc_id"), measure(f"`{text_column}`").alias("m"))
    return measured.select(
        "doc_id",
        *[F.col(f"m.{n}").alias(n) for n in MEASURES],
        F.expr(f"({_case(BASE_RULES, names)}) IS NOT NULL").alias("base_failed"),
        F.expr(f"({_case(ordered, names)}) IS NULL").alias("kept"),
    )
