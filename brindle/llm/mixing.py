"""Mixing by soft membership: document rates whose expected tokens per domain meet target weights.

A labelled table, documents with a known domain, trains a naive Bayes classifier over hashed words; every document
then has a posterior over the domains. Distributed projected-gradient least squares looks for nonnegative rates r with
sum(r * tokens * posterior) near the target of each domain. All work is DataFrame operations: only sums, one per
domain, reach the driver.

The gradient is scaled by a document's tokens and each residual by its domain's tokens, which makes the matrix of the
iteration a stochastic one: a step of 1 always descends. Rates begin at 1, so the result stays near "every document
once". A rate r stands for r copies on average: the whole part, and one more by a hash of the id with the chance of
the rest.

NULL and empty texts have no tokens; their rate follows from the prior. Rows without a domain are not learned from.
Without labelled rows there is one domain, "all". Domains without a target weight have the target 0, or with `keep_others`
their present part of the tokens, and the weights divide the rest; targets of domains that no labelled row has are left out. Repeated rows are documents of their own, with equal rates.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.session import materialize, scratch_of_its_own

BUCKETS = 1 << 14  # word hashes; with MOST_DOMAINS it bounds the model that is broadcast
MOST_DOMAINS = 32
PER_DOMAIN = 4_000  # labelled documents of each domain to learn from
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEMPER = 0.5  # evidence of n words counts as n ** TEMPER: words of a text are not independent
STEPS, TOLERANCE, WRITE_EVERY = 80, 1e-6, 8
_GRAIN = 1_000_000


def _words(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per word, and one without a word for a text that begins or ends between words."""
    word = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), BETWEEN)).alias("word")
    return docs.select(*keep, word).withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)))


def _sum(parts: list[Column]) -> Column:
    return reduce(add, parts)


def sample(labelled: DataFrame, per_domain: int = PER_DOMAIN) -> tuple[DataFrame, list[str]]:
    """About `per_domain` rows (text, domain) of each domain, picked by a hash of the id, and the domains.

    No more than MOST_DOMAINS domains may occur; their names and sizes are all that the driver gets.
    """
    known = labelled.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull())
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().limit(MOST_DOMAINS + 1).collect()}
    if len(sizes) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    share = F.lit(0)
    for domain, n in sizes.items():
        share = F.when(F.col("domain") == domain, min(_GRAIN, max(1, _GRAIN * per_domain // n))).otherwise(share)
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(_GRAIN)) < share)
    return picked.select("text", "domain"), sorted(sizes)


def train(labelled: DataFrame, per_domain: int = PER_DOMAIN) -> tuple[DataFrame, list[str]]:
    """The model: a row per bucket with l0, l1, ..., the log chance of the bucket in each domain; and the domains."""
    spark = labelled.sparkSession
    rows, domains = sample(labelled, per_domain)
    if not domains:
        return spark.range(BUCKETS).select(F.col("id").alias("bucket"), F.lit(0.0).alias("l0")), ["all"]
    words = _words(rows, "domain").where("word != ''")
    counts = words.groupBy("bucket").agg(
        *[F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"c{k}") for k, d in enumerate(domains)]
    )
    counts = materialize(counts, "counts")
    total = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)).alias(f"t{k}") for k in range(len(domains))]).first()
    chance = [
        F.log((F.coalesce(F.col(f"c{k}"), F.lit(0)) + 1) / F.lit(float(total[k] + BUCKETS))).alias(f"l{k}")
        for k in range(len(domains))
    ]
    every = spark.range(BUCKETS).select(F.col("id").alias("bucket"))
    return materialize(every.join(counts, "bucket", "left").select("bucket", *chance), "model"), domains


def posteriors(docs: DataFrame, model: DataFrame, n_domains: int) -> DataFrame:
    """doc_id, text_key, n_tokens, p0, p1, ... of every row of `docs`.

    The model is broadcast; its size is fixed by BUCKETS and MOST_DOMAINS. Words are added up in the task that reads
    their text, so what is shuffled is one row per document.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row"))
    is_word = F.when(F.col("word") != "", 1).otherwise(0)
    sums = (
        _words(rows, "doc_id", "text_key", "row").join(F.broadcast(model), "bucket")
        .groupBy("row", "doc_id", "text_key")
        .agg(F.sum(is_word).alias("n_tokens"), *[F.sum(is_word * F.col(f"l{k}")).alias(f"s{k}") for k in range(n_domains)])
    )
    damp = F.pow(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"), F.lit(TEMPER - 1))
    top = F.greatest(*[F.col(f"s{k}") for k in range(n_domains)]) if n_domains > 1 else F.col("s0")
    weights = sums.select(
        "doc_id", "text_key", "n_tokens", *[F.exp((F.col(f"s{k}") - top) * damp).alias(f"e{k}") for k in range(n_domains)]
    )
    whole = _sum([F.col(f"e{k}") for k in range(n_domains)])
    return weights.select("doc_id", "text_key", "n_tokens", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in range(n_domains)])


def solve(members: DataFrame, targets: list[float | None]) -> DataFrame:
    """Add `rate` to rows with n_tokens and p0, p1, ...; `targets` are shares of all tokens, one per domain.

    A domain with None for its target keeps the tokens that it has; the targets of the others are then shares of the rest.

    Minimises the sum over domains of (expected tokens - target)^2 / tokens of the domain, over rates >= 0.
    """
    count = range(len(targets))
    share = [F.col("n_tokens") * F.col(f"p{k}") for k in count]
    there = [x or 0.0 for x in members.agg(*[F.sum(s) for s in share]).first()]
    total = sum(there)
    rest = total - sum(x for x, t in zip(there, targets, strict=True) if t is None)
    want = [x if t is None else rest * t for x, t in zip(there, targets, strict=True)]
    at, pending = members.withColumn("rate", F.lit(1.0)), 0
    for _ in range(STEPS if total else 0):
        have = at.agg(*[F.sum(s * F.col("rate")) for s in share]).first()
        over = [(have[k] - want[k]) / there[k] if there[k] else 0.0 for k in count]
        if max(abs(over[k]) * there[k] for k in count) <= TOLERANCE * total:
            break
        if pending == WRITE_EVERY:
            at, pending = materialize(at, "rates"), 0
        step = _sum([F.lit(float(over[k])) * F.col(f"p{k}") for k in count])
        at, pending = at.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - step)), pending + 1
    return at


def rates(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], per_domain: int = PER_DOMAIN, seed: int = 1,
    keep_others: bool = False,
) -> DataFrame:
    """One row per document: doc_id, text_key, n_tokens, domain (the likeliest), membership (its posterior), rate, copies.

    `labelled` has doc_id, text and domain; `weights` gives each domain's part of the tokens, in any unit. With
    `keep_others` domains without a weight keep their present part, and `weights` divide the rest.
    """
    model, domains = train(labelled, per_domain)
    members = materialize(posteriors(docs, model, len(domains)), "members")
    wanted = [float(weights.get(d, 0.0)) for d in domains]
    scale = sum(wanted)
    named = [d in weights or not keep_others for d in domains]
    targets = [(w / scale if scale else 1.0 / sum(named)) if n else None for w, n in zip(wanted, named, strict=True)]
    solved = materialize(solve(members, targets), "solved")
    chance = [F.struct(F.col(f"p{k}").alias("p"), F.lit(d).alias("domain")) for k, d in enumerate(domains)]
    best = F.greatest(*chance) if len(chance) > 1 else chance[0]
    luck = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(_GRAIN)) / _GRAIN
    copies = F.floor("rate") + F.when(luck < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return solved.select(
        "doc_id", "text_key", "n_tokens", best["domain"].alias("domain"), best["p"].alias("membership"), "rate",
        copies.cast("bigint").alias("copies"),
    )


def mixture(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], per_domain: int = PER_DOMAIN, seed: int = 1,
    keep_others: bool = False,
) -> DataFrame:
    """The rows of `docs` that are drawn at least once, with `rate` and `copies`."""
    with scratch_of_its_own(docs.sparkSession) as keep:
        drawn = rates(docs, labelled, weights, per_domain, seed, keep_others).where(F.col("copies") > 0)
        drawn = drawn.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
            F.max("rate").alias("_rate"), F.max("copies").alias("_copies")
        )
        drawn = keep(drawn, "drawn")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    own = [c for c in docs.columns if c not in ("rate", "copies")]
    return docs.join(drawn, same).select(*own, F.col("_rate").alias("rate"), F.col("_copies").alias("copies"))
