"""Document rates that mix soft domains to target token totals, in DataFrame operations only.

A naive Bayes classifier over hashed words, fitted on a bounded sample of a labelled table, gives
each document posteriors over domains instead of one hard domain. Nonnegative rates of the
documents are then fitted so that the expected tokens of each domain, sum of rate * tokens *
posterior, meet the targets in least squares. Each projected-gradient step is one distributed
aggregation: it brings the domain totals and the small matrix that scales the gradient to the
driver (a number for each pair of domains), and every rate moves along its own posteriors and is
cut at zero; where cuts spoil the scaled step, a plain gradient step follows, which always lowers the error. Rates start at 1, so a document moves only as far as its domains need.

Every row is a document of its own and comes back, with a null or shared id too; rows are told apart by a 128-bit
hash of id and text, and repeated rows, which are alike in both, get one rate. A label holds for all rows of its id.
Null, empty texts: no tokens; their posteriors are the priors of the sample. Without labelled rows every domain is
alike. Empty tables give no rows. Targets beyond what the documents
can give are approached: the error falls with every one of at most STEPS steps. Of other columns those named like a result (tokens, rate, p_<domain>) give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from intentloom.llm.runtime import stored

#: Labelled documents of each domain that the classifier is fitted on, at most.
PER_DOMAIN = 3000
BUCKETS = 1 << 16
#: Pseudo-counts with which a word's rate in a domain is drawn towards its rate overall.
SMOOTHING = 20.0
#: Log-odds of a document are divided by this: words are not independent.
TEMPERATURE = 4.0
STEPS = 12
TARGETS = {"good": 0.75, "poor": 0.22, "toxic": 0.03}


def domain_of_labels() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")


def row_key(id_col: str, text_col: str) -> Column:
    return F.struct(F.xxhash64(id_col, text_col).alias("a"), F.xxhash64(F.lit("row"), text_col, id_col).alias("b"))


def _buckets(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, bucket, first) of every word; a row without words has one null bucket, and each row one ``first``."""
    bare = F.translate(F.lower(F.col(text_col)), "\t\n\x0b\f\r", "     ")
    words = docs.select(F.col(key), F.posexplode_outer(F.split(bare, " ")).alias("pos", "word"))
    bucket = F.when(F.col("word") != "", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)))
    return words.select(key, bucket.alias("bucket"), (F.coalesce("pos", F.lit(0)) == 0).alias("first"))


def posteriors(docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, copies, tokens, p_<domain>...) of each distinct row hash. ``labels`` has (doc_id, domain)."""
    first = W.partitionBy("domain")
    sample = (
        labels.select(F.col("doc_id").alias("label_id"), "domain").where(F.col("domain").isin(domains)).distinct()
        .withColumn("r", F.row_number().over(first.orderBy(F.xxhash64("label_id"), "label_id")))
        .where(F.col("r") <= PER_DOMAIN).select("label_id", "domain")
    )
    small = F.broadcast(sample)  # PER_DOMAIN rows for each domain at most
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.join(small, F.col("doc_id") == F.col("label_id")).select("domain", "text")
    counts = _buckets(known, "domain", "text").where("bucket is not null").groupBy("bucket").agg(
        *(F.count(F.when(F.col("domain") == d, 1)).alias(f"n_{i}") for i, d in enumerate(domains))
    )
    counts = stored(counts, "words")
    total = counts.agg(*(F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(domains)))).first()
    sizes = [float(x or 0) for x in total]
    priors = sample.groupBy("domain").count().collect()
    priors = {r["domain"]: r["count"] for r in priors}
    everyone = sum(priors.values()) + len(domains)
    prior = [(priors.get(d, 0) + 1) / everyone for d in domains]
    overall = sum((F.col(f"n_{i}") for i in range(1, len(domains))), F.col("n_0")) / max(1.0, sum(sizes))
    weights = counts.select(
        F.col("bucket").alias("b"),
        *(
            F.log((F.col(f"n_{i}") + SMOOTHING * BUCKETS ** 0.5 * overall) / (size + SMOOTHING * BUCKETS ** 0.5) / overall).alias(f"w_{i}")
            for i, size in enumerate(sizes)
        ),
    )
    words = _buckets(rows.select(row_key("doc_id", "text").alias("row"), "text"), "row", "text")
    scored = words.join(F.broadcast(weights), F.col("bucket") == F.col("b"), "left")  # BUCKETS rows at most
    sums = scored.groupBy("row").agg(
        F.count_if("first").alias("copies"), F.count("bucket").alias("n"),
        *(F.coalesce(F.sum(f"w_{i}"), F.lit(0.0)).alias(f"all_{i}") for i in range(len(domains)))
    ).select("row", "copies", F.expr("n div copies").alias("tokens"), *((F.col(f"all_{i}") / F.col("copies")).alias(f"s_{i}") for i in range(len(domains))))
    logit = [F.col(f"s_{i}") / TEMPERATURE + F.log(F.lit(p)) for i, p in enumerate(prior)]
    top = F.greatest(*logit) if len(logit) > 1 else logit[0]
    lifted = sums.select("row", "copies", "tokens", *(F.exp(x - top).alias(f"e_{i}") for i, x in enumerate(logit)))
    norm = sum((F.col(f"e_{i}") for i in range(1, len(domains))), F.col("e_0"))
    return lifted.select("row", "copies", "tokens", *((F.col(f"e_{i}") / norm).alias(f"p_{d}") for i, d in enumerate(domains)))


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """The few unknowns of a step, one for each domain, with a little ridge."""
    n = len(right)
    ridge = 1e-9 * max(1e-300, max(matrix[i][i] for i in range(n)))
    rows = [[*matrix[i], right[i]] for i in range(n)]
    for i in range(n):
        rows[i][i] += ridge
    for i in range(n):
        best = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[best] = rows[best], rows[i]
        for r in range(n):
            if r != i and rows[i][i]:
                f = rows[r][i] / rows[i][i]
                rows[r] = [a - f * b for a, b in zip(rows[r], rows[i], strict=True)]
    return [rows[i][n] / rows[i][i] if rows[i][i] else 0.0 for i in range(n)]


def fit_rates(members: DataFrame, targets: dict[str, float], steps: int = STEPS, tolerance: float = 1e-6) -> DataFrame:
    """Add ``rate`` to (copies, tokens, p_<domain>...) so that domain totals meet shares of all tokens."""
    domains = list(targets)
    p = [F.col(f"p_{d}") for d in domains]
    k = len(domains)
    everything = float(members.agg(F.sum(F.expr("tokens * copies"))).first()[0] or 0)
    share = sum(targets.values())
    goal = [everything * targets[d] / share for d in domains]

    def totals(rate: Column) -> tuple[list[float], list[list[float]]]:
        n = F.expr("tokens * copies").cast("double")
        live = F.when(rate > 0, n).otherwise(0.0)
        got = members.agg(
            *(F.sum(rate * n * p[i]) for i in range(k)), *(F.sum(live * p[i] * p[j]) for i in range(k) for j in range(k))
        ).first()
        flat = [float(x or 0) for x in got]
        return flat[:k], [flat[k + i * k : k + i * k + k] for i in range(k)]

    rate: Column = F.lit(1.0)
    at, scale = totals(rate)
    error = sum((a - g) ** 2 for a, g in zip(at, goal, strict=True))
    steepest = sum(scale[i][i] for i in range(k))  # no less than the gradient's Lipschitz constant
    for _ in range(steps):
        if error <= (tolerance * max(1.0, everything)) ** 2:
            break
        over = [a - g for a, g in zip(at, goal, strict=True)]
        scaled = _solve(scale, over)
        for move in (*([x * size for x in scaled] for size in (1.0, 1 / 4, 1 / 16)), [x / steepest for x in over]):
            along = sum((F.lit(move[i]) * p[i] for i in range(1, k)), F.lit(move[0]) * p[0])
            tried = F.greatest(F.lit(0.0), rate - along)
            new_at, new_scale = totals(tried)
            new_error = sum((a - g) ** 2 for a, g in zip(new_at, goal, strict=True))
            if new_error < error:
                break
        else:
            break
        rate, at, scale, error = tried, new_at, new_scale, new_error
    return members.withColumn("rate", rate)


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", whole: bool = False
) -> DataFrame:
    """(doc_id, tokens, p_<domain>..., rate) of every row, or ``whole`` rows with these columns added.

    ``labels`` has (doc_id, domain); targets are token shares.
    """
    targets = targets or TARGETS
    added = ["tokens", *(f"p_{d}" for d in targets), "rate"]
    members = fit_rates(stored(posteriors(docs, labels, list(targets), id_col, text_col), "members"), targets)
    own = [F.col(c) for c in docs.columns if c.lower() not in added] if whole else [F.col(id_col).alias("doc_id")]
    rows = docs.select(row_key(id_col, text_col).alias("k"), F.struct(*own).alias("d"))
    found = members.select(F.col("row").alias("k"), F.struct(*added).alias("m"))
    return rows.join(found, "k").select("d.*", "m.*")
