"""Quality rules with verdicts on whole hosts, with DataFrame functions only.

Every document is measured and held against rules. Failures are counted by rule and
host; a host's rate of failures is shrunk towards that of all hosts by a beta prior
whose strength is fitted to how much hosts differ (moments of the beta-binomial), so
that a host of few documents is not judged by them alone (the prior weighs ten documents at
least). A host whose shrunk rate of a
rule is high loses the documents that fail this rule; a host where it is very high
loses all. The verdicts are joined back to the documents.

Repeated word windows are found in a document's own row: the hashes of its windows,
sorted, with equal neighbours. So texts are never shuffled, only their counts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, stored

# Fixed values of the contract: what counts as a symbol, and the two base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3

LEAST_PRIOR = 10.0           # documents that the prior weighs at least
SPACES = " \t\n\x0b\x0c\r"
BASE_RULES = {
    "few_words": f"n_words < {LEAST_WORDS}",
    "repeated_words": f"100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words",
}
# What hosts are judged by as well; alone they do not fail a document.
HOST_RULES = {
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 3 * n_words or word_chars > 10 * n_words)",
}
RULES = BASE_RULES | HOST_RULES


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def measured(documents: DataFrame, host: str = "source") -> DataFrame:
    """Per row of ``documents``: doc_id, host, the counts that rules are made of, and what fails."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select("doc_id", F.col(host).cast("string").alias("host"), text.alias("text"))
    words = rows.select(
        "doc_id", "host", F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0).alias("lines"),
        (F.length("text") - _count(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"))
    # one step per projection: each array is made once, then read by place
    counted = words.select(
        "doc_id", "host", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.expr(f"""
            transform(if(size(words) >= {WINDOW}, sequence(0, size(words) - {WINDOW}), array()),
                      i -> struct(xxhash64({', '.join(f'words[i + {j}]' for j in range(WINDOW))}) as mark,
                                  i as place))""")).alias("windows"))
    repeated = counted.withColumn("places", F.sort_array(F.expr("""
        transform(filter(windows, (w, i) -> coalesce(w.mark = get(windows, i - 1).mark, false)
                                         or coalesce(w.mark = get(windows, i + 1).mark, false)),
                  w -> w.place)"""))).drop("windows")
    # windows from sorted places: each covers what the one before it does not
    return repeated.withColumn("n_repeat_words", F.expr(f"""
        aggregate(places, named_struct('words', 0L, 'last', -{WINDOW}),
                  (a, p) -> named_struct('words', a.words + least({WINDOW}, p - a.last), 'last', p),
                  a -> a.words)""")).drop("places") \
        .select("*", *[F.expr(rule).alias(f"fails_{name}") for name, rule in RULES.items()])


def host_verdicts(rows: DataFrame, reject: float = 0.5, watch: float = 0.2, above: float = 2.0) -> DataFrame:
    """Per host of ``rows`` (``measured``): host, n, and by rule the shrunk rate and whether it is watched;
    rejected: some rule's rate is ``reject`` or more. Watched for a rule: its rate is ``watch`` or
    more and ``above`` times that of all documents.
    """
    hosts = rows.groupBy("host").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(f"fails_{r}").cast("long")).alias(f"failed_{r}") for r in RULES])
    hosts = stored(hosts, "host-failures")
    # one row of a few sums, whatever the number of hosts
    pooled = hosts.agg(F.count("*").alias("hosts"), F.sum("n").alias("n"),
                       F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
                       *[F.sum(f"failed_{r}").alias(r) for r in RULES]).first()
    if not pooled.hosts:
        return hosts.select("host", "n", *[F.lit(0.0).alias(f"rate_{r}") for r in RULES],
                            *[F.lit(False).alias(f"watched_{r}") for r in RULES], F.lit(False).alias("rejected"))
    mean = {r: pooled[r] / pooled.n for r in RULES}
    spread = hosts.agg(*[F.sum(F.col("n") * (F.col(f"failed_{r}") / F.col("n") - mean[r]) ** 2).alias(r)
                         for r in RULES]).first()
    rates, watched = {}, {}
    for r in RULES:
        m, noise = mean[r], mean[r] * (1 - mean[r])
        room = pooled.n - pooled.squares / pooled.n - (pooled.hosts - 1)
        alike = (spread[r] - noise * (pooled.hosts - 1)) / (noise * room) if noise > 0 and room > 0 else 0.0
        if alike <= 0:                   # hosts differ no more than by chance: one rate for all
            rates[r] = F.lit(float(m))
        else:
            strength = max(1 / min(alike, 1.0) - 1, LEAST_PRIOR)
            rates[r] = (F.col(f"failed_{r}") + m * strength) / (F.col("n") + strength)
        watched[r] = (rates[r] >= watch) & (rates[r] >= above * m)
    rejected = F.lit(False)
    for rate in rates.values():
        rejected |= rate >= reject
    return hosts.select("host", "n", *[x.alias(f"rate_{r}") for r, x in rates.items()],
                        *[x.alias(f"watched_{r}") for r, x in watched.items()], rejected.alias("rejected"))


def quality_verdicts(documents: DataFrame, host: str = "source", reject: float = 0.5, watch: float = 0.2,
                     above: float = 2.0) -> DataFrame:
    """Judge every row of ``documents`` (doc_id, text, and the column ``host``).

    Returns per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, host, host_verdict ('accepted', 'watched', 'rejected'). Words are runs of characters
    other than space and \\t-\\r. A null or empty text has no words, so it fails. A null host
    is a host of its own. Repeated rows and ids are judged one by one and count as often as they
    come; a null doc_id stays. An empty table gives no rows. Other columns are ignored. Windows are compared by 64-bit
    hashes: two different ones of a text of n words agree with a chance of about n^2 / 2^65. A
    text is held in one row, with about 60 bytes a word beside it.
    """
    rows = stored(measured(documents, host), "quality-rows")
    verdicts = host_verdicts(rows, reject, watch, above)
    anyhow = F.col("rejected")
    for r in RULES:
        anyhow |= F.col(f"watched_{r}")
    # only hosts that are not simply accepted are joined
    verdicts = verdicts.where(anyhow).select(
        F.col("host").isNull().alias("unnamed"), F.coalesce("host", F.lit("")).alias("name"), "rejected",
        *[f"watched_{r}" for r in RULES])
    judged = rows.withColumn("unnamed", F.col("host").isNull()) \
        .withColumn("name", F.coalesce("host", F.lit(""))).join(verdicts, ["unnamed", "name"], "left")
    failed, lost = F.lit(False), F.coalesce("rejected", F.lit(False))
    for r in BASE_RULES:
        failed |= F.col(f"fails_{r}")
    for r in RULES:
        lost |= F.coalesce(F.col(f"watched_{r}"), F.lit(False)) & F.col(f"fails_{r}")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~lost).alias("kept"), "host",
        F.when(F.col("rejected").isNull(), "accepted").when(F.col("rejected"), "rejected")
        .otherwise("watched").alias("host_verdict"))
