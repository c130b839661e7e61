"""Toxicity: a convolutional text classifier in numpy over hashed word embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.decontaminate import words_of
from orderloom.llm.rows import add_columns, texts_of, to_rows, written

BUCKETS, DIMENSIONS = 1 << 16, 12
WIDTHS, FILTERS = (1, 2, 3), 8

# Labelled rows, and bytes of their texts, up to which the model is fitted in the driver. With
# more of them it is fitted where they are, over all of them just the same.
TRAINING_ROWS = 8_000
TRAINING_BYTES = 128 << 20

# Fitting where the rows are: texts per share that descends by itself, and how often the shares'
# models are averaged.
SHARE_ROWS, ROUNDS = 4_096, 4
# Texts a share has in memory at a time.
CHUNK_ROWS = 512
# Sums of moves and of logits must not depend on the order of the tasks: whole multiples of these.
MOVE_UNIT, LOGIT_UNIT = 2.0**-32, 1e-3

# Distinct words a task remembers with their filter responses (200 bytes each).
MOST_WORDS = 500_000

# Frequent words by which a text shows its language. Fixed values.
LANGUAGES = {
    "en": ("the", "of", "and", "to", "is", "that", "with", "was", "for", "it"),
    "fr": ("le", "les", "des", "et", "du", "est", "une", "dans", "pour", "sur"),
    "de": ("der", "die", "und", "den", "das", "ist", "nicht", "mit", "ein", "zu"),
    "es": ("el", "los", "las", "y", "por", "con", "su", "del", "una", "al"),
}
OTHER = len(LANGUAGES)


def tokens(text: str) -> list[bytes]:
    return words_of(text.lower())


def buckets(word: bytes) -> tuple[int, int, int]:
    """The word's own bucket and those of its first four and five bytes, which stems share."""
    return tuple(xxhash.xxh32_intdigest(part, seed=k) % BUCKETS for k, part in enumerate((word, word[:4], word[:5])))


class Words:
    """Numbers for distinct words; number 0 pads texts shorter than the widest filter."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {b"": 0}
        self.languages = {w.encode(): k for k, ws in enumerate(LANGUAGES.values()) for w in ws}

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        numbers = self.numbers
        pad = np.zeros(max(WIDTHS) - 1, np.int32)
        out = []
        for text in texts:
            found = tokens(text)
            ids = [numbers.setdefault(w, len(numbers)) for w in found]
            out.append(np.concatenate([np.array(ids, np.int32), pad]) if ids else np.zeros(max(WIDTHS), np.int32))
        return out

    def buckets(self, known: int = 0) -> np.ndarray:
        new = list(self.numbers)[known:]
        return np.array([buckets(w) for w in new], np.int64).reshape(-1, 3)

    def votes(self, known: int = 0) -> np.ndarray:
        new = list(self.numbers)[known:]
        return np.array([self.languages.get(w, OTHER) for w in new], np.int8)


def language(votes: np.ndarray) -> int:
    """The language most of a text's frequent words belong to; OTHER without any."""
    counts = np.bincount(votes, minlength=OTHER + 1)[:OTHER]
    return int(counts.argmax()) if counts.any() else OTHER


@dataclass
class ConvolutionalModel:
    embedding: np.ndarray  # bucket, dimension
    filters: list[np.ndarray]  # per width: width, dimension, filter
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray  # logit per language and OTHER

    def responses(self, word_buckets: np.ndarray) -> np.ndarray:
        """What a word adds to each filter at each of its offsets."""
        words = self.embedding[word_buckets].sum(1)
        return np.concatenate([words @ f[o] for f in self.filters for o in range(len(f))], axis=1).astype(np.float32)

    def logit(self, responses: np.ndarray) -> float:
        """Of a text, from the responses of its words in order: convolve, take each filter's maximum."""
        best, at = [], 0
        for f, b in zip(self.filters, self.biases):
            n = len(responses) - len(f) + 1
            total = responses[:n, at : at + FILTERS]
            for o in range(1, len(f)):
                total = total + responses[o : o + n, at + o * FILTERS : at + (o + 1) * FILTERS]
            best.append(total.max(0) + b)
            at += len(f) * FILTERS
        return float(np.maximum(np.concatenate(best), 0) @ self.weights + self.bias)


def _blank(rng: np.random.Generator) -> ConvolutionalModel:
    flat = DIMENSIONS * BUCKETS
    return ConvolutionalModel(
        rng.normal(0, 0.02, flat).reshape(BUCKETS, DIMENSIONS),
        [rng.normal(0, 0.2, (w, DIMENSIONS, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.2, len(WIDTHS) * FILTERS),
        0.0,
        np.zeros(OTHER + 1),
    )


def _constant(model: ConvolutionalModel, rows: int, ones: int) -> ConvolutionalModel:
    """The smoothed share of label 1 for every text."""
    smoothed = (ones + 1) / (rows + 2)
    model.weights[:] = 0
    model.bias = float(np.log(smoothed / (1 - smoothed)))
    return model


def _start_from(model: ConvolutionalModel, log_odds: np.ndarray) -> None:
    """The buckets' log-odds as the first dimension, which half of the filters look at from the start."""
    model.embedding[:, 0] = log_odds
    model.embedding[list(buckets(b""))] = 0
    for f in model.filters:
        f[:, 0, : FILTERS // 2] = np.abs(f[:, 0, : FILTERS // 2]) + 0.5
    model.weights[:] = np.where(np.arange(len(model.weights)) % FILTERS < FILTERS // 2, 0.3, model.weights)


def _smoothed_log_odds(rows: list[np.ndarray], word_buckets: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per bucket, how much more often texts of label 1 hold it than others do."""
    seen = np.zeros((2, BUCKETS), np.int64)
    for row, label in zip(rows, labels):
        seen[label][np.unique(word_buckets[row])] += 1
    return _log_odds(seen, [np.sum(labels == k) for k in (0, 1)])


def _log_odds(seen: np.ndarray, sizes: list[int]) -> np.ndarray:
    return np.log((seen[1] + 1.0) / (sizes[1] + 2.0)) - np.log((seen[0] + 1.0) / (sizes[0] + 2.0))


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.state = rate, {}

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        m, v, t = self.state.get(name, (np.zeros_like(value), np.zeros_like(value), 0))
        t += 1
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        self.state[name] = m, v, t
        value -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def fit(texts: list[str], labels: np.ndarray, share: float | None = None, epochs: int = 8, batch: int = 32, rate: float = 0.02, seed: int = 7) -> ConvolutionalModel:
    """A model of labelled texts.

    Three parts, told apart by position: on the first half each bucket's embedding gets
    its smoothed log-odds as a start; on the next third part the network is trained by
    gradient descent, so it learns what such odds are worth on texts they were not counted
    on; on the rest the threshold of each language is set. share is the part of label 1
    in the whole, if the texts were chosen by label. Without both classes the model
    gives the smoothed share.
    """
    rng = np.random.default_rng(seed)
    model = _blank(rng)
    labels = np.asarray(labels, int)
    if len(labels) == 0 or labels.min() == labels.max():
        return _constant(model, len(labels), labels.sum())
    words = Words()
    rows = words.rows(texts)
    word_buckets, votes = words.buckets(), words.votes()
    parts = np.arange(len(rows)) % 20
    odds, train, calibrate = (np.flatnonzero(p) for p in (parts < 10, (parts >= 10) & (parts < 16), parts >= 16))
    _start_from(model, _smoothed_log_odds([rows[i] for i in odds], word_buckets, labels[odds]))
    _descend(model, [rows[i] for i in train], word_buckets, labels[train], epochs, batch, rate, rng)
    _calibrate(model, [rows[i] for i in calibrate], word_buckets, votes, labels[calibrate], share)
    return model


def _descend(model, rows, word_buckets, labels, epochs, batch, rate, rng, adam=None, weights=None) -> None:
    """weights: of a text per label, if the texts are part of more; they count both labels alike."""
    if not len(rows):
        return
    adam = _Adam(rate) if adam is None else adam
    if weights is None:
        weights = [0.5 / max(1, (labels == k).sum()) * len(labels) for k in (0, 1)]
    balance = np.where(labels == 1, weights[1], weights[0])
    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(len(rows)), -(-len(rows) // batch)):
            grads = {
                "weights": np.zeros_like(model.weights),
                "bias": np.zeros(1),
                **{f"f{k}": np.zeros_like(f) for k, f in enumerate(model.filters)},
                **{f"b{k}": np.zeros_like(b) for k, b in enumerate(model.biases)},
            }
            touched: list[tuple[np.ndarray, np.ndarray]] = []
            for i in chosen:
                row = rows[i]
                held = word_buckets[row]
                embedded = model.embedding[held].sum(1)
                pooled, places = [], []
                for f, b in zip(model.filters, model.biases):
                    n = len(row) - len(f) + 1
                    total = sum(embedded[o : o + n] @ f[o] for o in range(len(f)))
                    at = total.argmax(0)
                    places.append(at)
                    pooled.append(total[at, np.arange(FILTERS)] + b)
                signal = np.concatenate(pooled)
                out = np.maximum(signal, 0)
                p = 1 / (1 + np.exp(-np.clip(out @ model.weights + model.bias, -30, 30)))
                error = (p - labels[i]) * balance[i] / len(chosen)
                grads["weights"] += error * out
                grads["bias"] += error
                back = error * model.weights * (signal > 0)
                for k, (f, at) in enumerate(zip(model.filters, places)):
                    g = back[k * FILTERS : (k + 1) * FILTERS]
                    grads[f"b{k}"] += g
                    for o in range(len(f)):
                        grads[f"f{k}"][o] += (embedded[at + o] * g[:, None]).T
                        touched.append((held[at + o], (f[o] * g).T))
            adam.step("weights", model.weights, grads["weights"] + 1e-3 * model.weights)
            bias = np.array([model.bias])
            adam.step("bias", bias, grads["bias"])
            model.bias = float(bias[0])
            for k, (f, b) in enumerate(zip(model.filters, model.biases)):
                adam.step(f"f{k}", f, grads[f"f{k}"])
                adam.step(f"b{k}", b, grads[f"b{k}"])
            where = np.concatenate([w for w, _ in touched])
            moves = np.concatenate([m for _, m in touched])
            for part in range(3):
                np.add.at(model.embedding, where[:, part], -rate * 0.5 * moves)
            model.embedding[word_buckets[0]] = 0


def _calibrate(model, rows, word_buckets, votes, labels, share) -> None:
    """The logit of least error per language, errors weighed as in the whole; drawn to the common one where texts are few."""
    if not len(rows) or labels.min() == labels.max():
        return
    responses = model.responses(word_buckets)
    logits = np.array([model.logit(responses[r]) for r in rows])
    spoken = np.array([language(votes[r]) for r in rows])
    here = labels.mean()
    share = here if share is None else share
    weight = np.where(labels == 1, share / here, (1 - share) / (1 - here))

    def least(mask: np.ndarray, prior: float | None) -> float:
        z, y, w = logits[mask], labels[mask], weight[mask]
        order = np.argsort(z)
        z, y, w = z[order], y[order], w[order]
        cuts = np.r_[z[0] - 1, (z[1:] + z[:-1]) / 2, z[-1] + 1]
        missed = np.r_[0, np.cumsum(w * (y == 1))]
        false = (w * (y == 0)).sum() - np.r_[0, np.cumsum(w * (y == 0))]
        cost = missed + false
        if prior is not None:
            cost = cost + 1e-3 * np.abs(cuts - prior)
        best = np.flatnonzero(cost <= cost.min() + 1e-9)
        return float(cuts[best[len(best) // 2]])

    common = least(np.ones(len(labels), bool), None)
    model.thresholds[:] = common
    for k in range(OTHER):
        mask = spoken == k
        if min((labels[mask] == 1).sum(), (labels[mask] == 0).sum()) >= 10:
            model.thresholds[k] = least(mask, common)


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", most_rows: int | None = None, most_bytes: int | None = None) -> ConvolutionalModel:
    """A model of all labelled documents.

    Up to TRAINING_ROWS of them with TRAINING_BYTES of text are fitted in the driver, more where they
    are (fit_distributed). Null ids, labels and labels without a document are passed over. An id
    counts once: with its larger label, and the text with the least digest. A caller may ask for
    fewer: most_rows of each class that come first by a hash of the id, and of their texts, in that
    order, as many whole ones as most_bytes hold.
    """
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.filter("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    sizes = known.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    share = (sizes["ones"] or 0) / sizes["n"] if sizes["n"] else None
    order = F.xxhash64("id")
    taken = known
    if most_rows is not None:
        halves = [known.filter(F.col("label") == k).orderBy(order, "id").limit(most_rows) for k in (0, 1)]
        taken = halves[0].unionByName(halves[1])
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = texts.join(taken, "id").groupBy("id").agg(
        F.first("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text")
    )
    rows = written(rows.withColumn("order", order), "labelled")
    if most_bytes is not None:
        narrow = rows.select("id", "order", F.octet_length("text").alias("bytes"))
        until = F.sum("bytes").over(Window.orderBy("order", "id").rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.join(narrow.withColumn("until", until).filter(F.col("until") <= most_bytes).select("id"), "id", "left_semi")
    found = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    if found["n"] > TRAINING_ROWS or (found["bytes"] or 0) > TRAINING_BYTES:
        return fit_distributed(rows, share)
    local = rows.toPandas().sort_values(["order", "id", "text"], kind="stable")
    return fit(local["text"].tolist(), local["label"].to_numpy(int), share)


def fit_distributed(rows: DataFrame, share: float | None = None, rounds: int = ROUNDS, batch: int = 32, rate: float = 0.02, seed: int = 7) -> ConvolutionalModel:
    """fit over rows (id, label, text) that stay where they are; ids are unique.

    The same three parts, told apart by a hash of the id. Buckets are counted by Spark. The descent
    runs in shares of some SHARE_ROWS texts, each of which starts from the common model; what the
    parameters moved by is added up by Spark and averaged over the shares that moved them, several
    times. Thresholds come from counts of the logits of the last part. Only counts and parameters,
    whose number is fixed, reach the driver. All sums are of whole numbers: the same rows give the
    same model, however they are dealt.
    """
    rng = np.random.default_rng(seed)
    model = _blank(rng)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(20)))
    kind = F.when(F.col("part") < 10, 0).when(F.col("part") < 16, 1).otherwise(2)
    sizes = np.zeros((3, 2), np.int64)
    for r in rows.groupBy(kind.alias("kind"), "label").count().collect():
        sizes[r["kind"], r["label"]] = r["count"]
    if 0 in sizes.sum(0):
        return _constant(model, int(sizes.sum()), int(sizes[:, 1].sum()))
    seen = np.zeros((2, BUCKETS), np.int64)
    counted = to_rows(rows.where("part < 10").select("label", "text"), _bucket_counts, "label int, bucket int, n long")
    counted = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    seen[counted["label"], counted["bucket"]] = counted["n"]
    _start_from(model, _log_odds(seen, sizes[0].tolist()))
    n = int(sizes[1].sum())
    if n:
        shares = -(-n // SHARE_ROWS)
        weights = [0.5 * n / max(1, int(k)) for k in sizes[1]]
        train = rows.where("part >= 10 and part < 16").withColumn("share", F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(shares)))
        train = train.withColumn("share", F.col("share").cast("int")).repartitionById(shares, "share")
        train = train.sortWithinPartitions("share", F.xxhash64("id"), "id")
        train = written(train.select("share", "label", "text"), "shares")
        for number in range(rounds):
            _average_round(model, train, number, weights, batch, rate, seed)
    if 0 not in sizes[2]:
        _calibrate_from_counts(model, _logit_counts(rows.where("part >= 16").select("label", "text"), model), share)
    return model


def _bucket_counts():
    """How many texts of each label hold a bucket, for the texts of a task."""

    def run(batches):
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            words = Words()
            rows, held = words.rows(texts_of(batch, "text")), words.buckets()
            for row, label in zip(rows, batch.column("label").to_pylist()):
                seen[label][np.unique(held[row])] += 1
        label, bucket = np.nonzero(seen)
        yield {"label": pa.array(label, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(seen[label, bucket])}

    return run


def _parameters(model: ConvolutionalModel) -> np.ndarray:
    """All parameters in rows of DIMENSIONS: one per bucket, then the others end to end."""
    rest = np.concatenate([model.weights, [model.bias], *[f.ravel() for f in model.filters], *model.biases])
    return np.concatenate([model.embedding, np.pad(rest, (0, -len(rest) % DIMENSIONS)).reshape(-1, DIMENSIONS)])


def _set_parameters(model: ConvolutionalModel, values: np.ndarray) -> None:
    model.embedding = values[:BUCKETS].copy()
    rest, at = values[BUCKETS:].ravel(), len(model.weights) + 1
    model.weights, model.bias = rest[: at - 1].copy(), float(rest[at - 1])
    for held in (model.filters, model.biases):
        for k, value in enumerate(held):
            held[k] = rest[at : at + value.size].reshape(value.shape).copy()
            at += value.size


_MOVES = [f"d{k}" for k in range(DIMENSIONS)]


def _average_round(model: ConvolutionalModel, train: DataFrame, number: int, weights: list[float], batch: int, rate: float, seed: int) -> None:
    """One pass of every share over its texts from the same model, and the mean of what they moved."""
    sent = train.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(batches):
            descent = None
            for rows in batches:
                of, labels, texts = rows.column("share").to_numpy(), rows.column("label").to_numpy(), texts_of(rows, "text")
                starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
                for start, end in zip(starts, [*starts[1:], len(of)]):
                    if descent is None or descent.share != of[start]:
                        if descent is not None:
                            yield descent.moves()
                        descent = _Descent(sent.value, int(of[start]), np.random.default_rng([seed, number, int(of[start])]), weights, batch, rate)
                    for at in range(start, end, CHUNK_ROWS):
                        descent.step(texts[at : min(end, at + CHUNK_ROWS)], labels[at : min(end, at + CHUNK_ROWS)].astype(int))
            if descent is not None:
                yield descent.moves()

        return run

    moved = to_rows(train, make, ", ".join(["place int", *[f"{d} long" for d in _MOVES]]))
    moved = moved.groupBy("place").agg(F.count("*").alias("shares"), *[F.sum(d).alias(d) for d in _MOVES])
    with _a_task_per_file(train.sparkSession):
        moved = moved.toPandas()
    values = _parameters(model)
    values[moved["place"]] += moved[_MOVES].to_numpy(float) * MOVE_UNIT / moved["shares"].to_numpy(float)[:, None]
    _set_parameters(model, values)
    model.embedding[list(buckets(b""))] = 0
    sent.unpersist()


@contextmanager
def _a_task_per_file(spark: SparkSession) -> Iterator[None]:
    """Within the block, small files are not read together: a share, which is one, is long work."""
    setting = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, f"{1 << 40}b")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class _Descent:
    """The gradient descent of one share, some texts at a time."""

    def __init__(self, model: ConvolutionalModel, share: int, rng: np.random.Generator, weights: list[float], batch: int, rate: float):
        self.model, self.share, self.rng, self.weights, self.batch, self.rate = deepcopy(model), share, rng, weights, batch, rate
        self.before, self.adam = _parameters(model), _Adam(rate)

    def step(self, texts: list[str], labels: np.ndarray) -> None:
        words = Words()
        rows = words.rows(texts)
        _descend(self.model, rows, words.buckets(), labels, 1, self.batch, self.rate, self.rng, self.adam, self.weights)

    def moves(self) -> dict[str, pa.Array]:
        by = np.rint((_parameters(self.model) - self.before) / MOVE_UNIT).astype(np.int64)
        places = np.flatnonzero(by.any(1))
        columns = {d: pa.array(by[places, k]) for k, d in enumerate(_MOVES)}
        return {"place": pa.array(places, pa.int32()), **columns}


def _logit_counts(rows: DataFrame, model: ConvolutionalModel) -> np.ndarray:
    """language, label, logit and how many texts have them; logits in steps of LOGIT_UNIT."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(batches):
            for batch in batches:
                words = Words()
                texts, votes = words.rows(texts_of(batch, "text")), words.votes()
                responses = sent.value.responses(words.buckets())
                logits = np.array([sent.value.logit(responses[r]) for r in texts], float)
                yield {
                    "language": pa.array([language(votes[r]) for r in texts], pa.int32()),
                    "label": batch.column("label"),
                    "logit": pa.array(np.rint(np.clip(logits, -30, 30) / LOGIT_UNIT).astype(np.int32)),
                }

        return run

    found = to_rows(rows, make, "language int, label int, logit int").groupBy("language", "label", "logit").count()
    return found.toPandas()[["language", "label", "logit", "count"]].to_numpy(np.int64)


def _calibrate_from_counts(model: ConvolutionalModel, counts: np.ndarray, share: float | None) -> None:
    """_calibrate, from counts of texts by language, label and logit."""
    spoken, labels, logits, n = counts.T
    here = n[labels == 1].sum() / n.sum()
    share = here if share is None else share
    weights = ((1 - share) / (1 - here), share / here)

    def least(mask: np.ndarray, prior: float | None) -> float:
        steps, at = np.unique(logits[mask], return_inverse=True)
        zeros, ones = (weights[k] * np.bincount(at, n[mask] * (labels[mask] == k)) for k in (0, 1))
        z = steps * LOGIT_UNIT
        cuts = np.r_[z[0] - 1, (z[1:] + z[:-1]) / 2, z[-1] + 1]
        cost = np.r_[0, np.cumsum(ones)] + zeros.sum() - np.r_[0, np.cumsum(zeros)]
        if prior is not None:
            cost = cost + 1e-3 * np.abs(cuts - prior)
        best = np.flatnonzero(cost <= cost.min() + 1e-9)
        return float(cuts[best[len(best) // 2]])

    common = least(np.ones(len(n), bool), None)
    model.thresholds[:] = common
    for k in range(OTHER):
        mask = spoken == k
        if min(n[mask & (labels == label)].sum() for label in (0, 1)) >= 10:
            model.thresholds[k] = least(mask, common)


def with_toxicity(df: DataFrame, model: ConvolutionalModel, text: str = "text", most_words: int = MOST_WORDS) -> DataFrame:
    """df with score, from 0 to 1, and predicted (1 from 0.5).

    0.5 is the threshold of the language that the text's own frequent words show; no
    other column is looked at. The whole text is convolved, whatever its length. Null and
    empty texts have the score of a text of padding. Texts that are equal score alike;
    other columns pass through, and columns named like a result give way to it.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = sent.value
        held: dict[str, object] = {}

        def step(batch):
            if not held or len(held["words"].numbers) > most_words:
                held.update(words=Words(), known=0, responses=np.zeros((0, sum(WIDTHS) * FILTERS), np.float32), votes=np.zeros(0, np.int8))
            words = held["words"]
            rows = words.rows(texts_of(batch, text))
            if len(words.numbers) > held["known"]:
                held["responses"] = np.concatenate([held["responses"], fitted.responses(words.buckets(held["known"]))])
                held["votes"] = np.concatenate([held["votes"], words.votes(held["known"])])
                held["known"] = len(words.numbers)
            responses, votes = held["responses"], held["votes"]
            z = np.array([fitted.logit(responses[r]) - fitted.thresholds[language(votes[r])] for r in rows], float)
            scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

        return step

    return add_columns(df, make, "score double, predicted int")
