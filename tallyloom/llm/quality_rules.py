"""Document and host quality rules in built-in expressions only.

Base figures of every whole text are row expressions: word windows are hashed to 64 bits, sorted with
their positions inside the row, and neighbours compared, so a text costs n log n in its own length and nothing
is exploded or shuffled. The figures are stored once, narrow, in the shared folder. Rule failures are then
counted by host (the document's ``source``) with partial aggregation, so a host with a third of all rows costs a
task no more than any other. Each rule's failure rates are shrunk with a beta prior fitted to the
rates of all hosts by moments; a host is rejected when a shrunk rate is over the limit. Only
rejected hosts are joined back.

Defined results: a missing or empty text has no words and fails the base rules; documents without a
host form one host; repeated rows count each time; other columns are ignored; an empty table gives no rows.
Word windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize

# What separates words, and what counts as a symbol.
BLANKS = " \\t\\n\\u000B\\u000C\\r"
SYMBOLS = "#*$%&|<>"

RULES = {
    "short": "n_words < 50",
    "repeated": "100 * n_repeat_words > 50 * n_words",
    "symbols": "5 * n_symbols > n_words",
    "lines": "n_dup_lines > 20",
    "long_words": "word_chars > 15 * n_words",
}
LIMIT = 0.5
LEAST_PRIOR, MOST_PRIOR = 1.0, 10000.0


def base_figures(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    split = rows.withColumn("words", F.expr(f"split(trim(BOTH '{BLANKS}' FROM text), '[{BLANKS}]+')"))
    counted = split.select(
        "doc_id",
        "host",
        "words",
        F.expr("if(words[0] = '', 0, size(words))").alias("n_words"),
        F.expr(f"length(text) - length(translate(text, '{SYMBOLS}', ''))").alias("n_symbols"),
        F.expr(f"filter(split(text, '\\n'), line -> trim(BOTH '{BLANKS}' FROM line) <> '')").alias("lines"),
    )
    windows = counted.select(
        "doc_id",
        "host",
        "n_words",
        "n_symbols",
        F.expr("size(lines) - size(array_distinct(lines))").alias("n_dup_lines"),
        F.expr("length(concat_ws('', words))").alias("word_chars"),
        F.expr(
            "if(n_words < 3, cast(array() as array<bigint>),"
            " transform(sequence(0, n_words - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"
        ).alias("windows"),
    )
    placed = windows.withColumn(
        "placed",
        F.expr(
            "if(size(array_distinct(windows)) = size(windows), cast(array() as array<struct<h: bigint, i: int>>),"
            " sort_array(transform(windows, (h, i) -> named_struct('h', h, 'i', i))))"
        ),
    ).drop("windows")
    repeated = placed.withColumn(
        "again",
        F.expr(
            "filter(placed, (x, k) -> (k > 0 and placed[k - 1].h = x.h) or (k + 1 < size(placed) and placed[k + 1].h = x.h))"
        ),
    ).drop("placed")
    covered = F.expr("size(array_distinct(flatten(transform(again, x -> array(x.i, x.i + 1, x.i + 2)))))")
    whole = lambda name: F.col(name).cast("long").alias(name)
    return repeated.select(
        "doc_id", "host", whole("n_words"), whole("word_chars"), whole("n_symbols"), whole("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def host_counts(figures: DataFrame) -> DataFrame:
    """One row per host: its documents and how many fail each rule."""
    fails = [F.count_if(F.expr(rule)).alias(name) for name, rule in RULES.items()]
    return figures.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *fails)


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and strength of each rule's beta prior, from the moments of the hosts' failure rates."""
    rates = [(F.avg(F.col(r) / F.col("n")).alias(f"{r}_m"), F.var_pop(F.col(r) / F.col("n")).alias(f"{r}_v")) for r in RULES]
    found = hosts.agg(*[c for pair in rates for c in pair]).first()
    out = {}
    for rule in RULES:
        mean, variance = found[f"{rule}_m"] or 0.0, found[f"{rule}_v"] or 0.0
        strength = mean * (1 - mean) / variance - 1 if variance > 0 else MOST_PRIOR
        out[rule] = mean, min(MOST_PRIOR, max(LEAST_PRIOR, strength))
    return out


def rejected_hosts(hosts: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Hosts with a rule whose shrunk failure rate is over the limit."""
    over = F.lit(False)
    for rule, (mean, strength) in priors(hosts).items():
        over |= (F.col(rule) + mean * strength) / (F.col("n") + strength) > limit
    return hosts.where(over).select("host", F.lit(True).alias("rejected"))


def judge(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limit: float = LIMIT) -> DataFrame:
    """Every document's figures, base_failed, and kept by its own and its host's verdict."""
    figures = materialize(base_figures(df, doc_id, text, host), "quality-figures")
    hosts = materialize(host_counts(figures), "quality-hosts")
    rejected = rejected_hosts(hosts, limit)
    joined = figures.join(rejected.withColumnRenamed("host", "bad_host"), F.col("host").eqNullSafe(F.col("bad_host")), "left")
    failed = F.expr(f"{RULES['short']} or {RULES['repeated']}")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("rejected").isNull()).alias("kept"),
    )


def _shrunk(rule: str) -> str:
    strength = (
        f"CASE WHEN v_{rule} > 0 THEN least({MOST_PRIOR}, greatest({LEAST_PRIOR}, m_{rule} * (1 - m_{rule}) / v_{rule} - 1))"
        f" ELSE {MOST_PRIOR} END"
    )
    return f"({rule} + m_{rule} * ({strength})) / (n + {strength}) > {LIMIT}"


ORACLE = f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT rid, doc_id, source, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM base
), windows AS (
  SELECT rid, generate_series AS i, list_extract(words, i + 1) || ' ' || list_extract(words, i + 2) || ' ' || list_extract(words, i + 3) AS w
  FROM parts, generate_series(0, len(words) - 3)
), twice AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, generate_series(0, 2) AS g(k) GROUP BY rid
), figures AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN covered c USING (rid)
), hosts AS (
  SELECT source, count(*) AS n, {', '.join(f'count(*) FILTER ({rule}) AS {name}' for name, rule in RULES.items())} FROM figures GROUP BY source
), prior AS (
  SELECT {', '.join(f'avg({r} / n) AS m_{r}, var_pop({r} / n) AS v_{r}' for r in RULES)} FROM hosts
), rejected AS (
  SELECT source, true AS bad FROM hosts, prior WHERE {' OR '.join(_shrunk(r) for r in RULES)}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({RULES['short']} OR {RULES['repeated']}) AS base_failed,
  NOT ({RULES['short']} OR {RULES['repeated']}) AND bad IS NULL AS kept
FROM figures f LEFT JOIN rejected r ON f.source IS NOT DISTINCT FROM r.source
"""
