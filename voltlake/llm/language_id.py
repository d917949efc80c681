"""Language identification by a sparse multinomial logistic regression on character n-grams."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .names import shielded
from .wordhash import mix, release_memory, slices

UNKNOWN = "und"

MAX_N = 3
BITS = 17
# The classifier is fitted on about so many labelled rows of each language.
ROWS_PER_LANGUAGE = 1500
# Values of the language column that the model may have; each adds a column of weights.
MOST_LANGUAGES = 500
# Of these rows one in five is kept from fitting, to calibrate on.
CALIBRATION_PART = 5
EPOCHS = 3
NONE = 1 << BITS
_CHARS_PER_STEP = 1 << 16
_SPREAD = mix(np.arange(1, MAX_N + 2, dtype=np.uint64)) | np.uint64(1)
# A small calibration set without errors would otherwise sharpen the scores without end.
_MIN_TEMPERATURE, _MAX_TEMPERATURE = 0.5, 20.0


@dataclass
class Penalties:
    """Follow-the-regularised-leader: learning rate ``alpha``/(``beta`` + root of squared gradients)."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.01


@dataclass
class Model:
    """``weights`` already hold the inverse document frequencies: [feature, language]."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature numbers of the n-grams of all texts, by n, and the first place of each text.

    A text is lower-cased; an n-gram of 1 to MAX_N characters starts at each character.
    Those that would reach into the next text have the number NONE.
    """
    lowered = [(t or "").lower() for t in texts]
    first = np.append(0, np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered))))
    joined = "".join(lowered).encode("utf-32-le", "surrogatepass")
    chars = np.frombuffer(joined, np.uint32).astype(np.uint64)
    code, features = chars.copy(), []
    for n in range(1, MAX_N + 1):
        if n > 1:
            code <<= np.uint64(21)
            code[: len(chars) - n + 1] |= chars[n - 1 :]
        # Multiplication spreads the code; its highest bits are the feature.
        feature = ((code * _SPREAD[n]) >> np.uint64(64 - BITS)).astype(np.int64)
        for k in range(1, n):
            feature[np.maximum(first - k, 0)[first >= k]] = NONE
        features.append(feature)
    return features, first


def _pieces(texts: list[str | None]):
    """Ranges of rows with about 65,000 characters; a longer text is a range of its own."""
    begin = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= _CHARS_PER_STEP:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _document_frequencies(batches):
    """How many of a task's documents have each feature."""
    total = np.zeros(NONE + 1, np.int64)
    last = np.zeros(NONE + 1, np.int64)
    documents = 0
    for batch in (part for whole in batches for part in slices(whole, whole.schema.names[0])):
        texts = batch.column(0).to_pylist()
        for a, b in _pieces(texts):
            features, first = _grams(texts[a:b])
            for i, j in zip(first[:-1], first[1:]):
                mine = np.concatenate([feature[i:j] for feature in features])
                # Of equal features only the last one written finds its own place again.
                place = np.arange(len(mine))
                last[mine] = place
                total[mine[last[mine] == place]] += 1
        documents += len(texts)
    release_memory()
    used = np.flatnonzero(total[:NONE])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(used, -1), pa.int32()),
            pa.array(np.append(total[used], documents), pa.int64()),
        ],
        names=["feature", "n"],
    )


def _counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their relative frequencies."""
    features = np.concatenate(_grams([text])[0])
    found, n = np.unique(features[features < NONE], return_counts=True)
    return found, n / max(1, n.sum())


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


# Relative frequencies are small; this puts the inputs near 1 for the learning rate.
_SCALE = 20.0


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, penalties: Penalties, epochs: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias; ``rows`` are features, values and the number of the language.

    A weight is zero until its summed gradient exceeds the l1 penalty, so the
    model stays sparse. The bias is not penalised.
    """
    p = penalties
    size = (1 << BITS) + 1
    z, squares = np.zeros((size, n_languages)), np.zeros((size, n_languages))

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size - 1, 0.0, p.l1)[:, None]
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((p.beta + np.sqrt(squares[at])) / p.alpha + p.l2)

    order = np.random.RandomState(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            features, values, language = rows[k]
            at, x = np.append(features, size - 1), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[language] -= 1
            gradient = x[:, None] * error
            step = (np.sqrt(squares[at] + gradient**2) - np.sqrt(squares[at])) / p.alpha
            z[at] += gradient - step * w
            squares[at] += gradient**2
    all_weights = weights(np.arange(size))
    return all_weights[:-1], all_weights[-1]


def fit_temperature(scores: np.ndarray, languages: np.ndarray) -> float:
    """The divisor of the scores with the least cross-entropy, by golden-section search."""
    if not len(scores):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(scores / np.exp(log_t))[np.arange(len(languages)), languages]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high = np.log(_MIN_TEMPERATURE), np.log(_MAX_TEMPERATURE)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    epochs: int = EPOCHS,
    penalties: Penalties | None = None,
) -> Model:
    """Fits the classifier on the rows of ``labelled`` that have a text and a language.

    The document frequencies come from all these rows. The weights come from about
    ``rows_per_language`` rows of each language, those with the smallest hashes of their
    ids and texts. Without any such row the model has no language.
    """
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    per_language = counts.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    languages = sorted(r["lang"] for r in per_language)
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)

    counted = rows.select(text_col).mapInArrow(_document_frequencies, "feature int, n long")
    frequency = np.zeros(1 << BITS)
    n_rows = 0
    for row in counted.groupBy("feature").agg(F.sum("n").alias("n")).toLocalIterator():
        if row["feature"] < 0:
            n_rows = row["n"]
        else:
            frequency[row["feature"]] = row["n"]
    inverse = np.log((1 + n_rows) / (1 + frequency)) + 1

    # Uniform in [0, 1) and the same on every run; a language is thinned by its own count.
    draw = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)) / (1 << 30)
    share = F.lit(0.0)
    for r in per_language:
        part = min(1.0, rows_per_language / r["n"])
        share = F.when(F.col(lang_col) == r["lang"], F.lit(part)).otherwise(share)
    number = {name: k for k, name in enumerate(languages)}
    fit, check = [], []

    def features(batches):
        for batch in batches:
            found = [_counts_of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())),
                    pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
                ],
                names=["lang", "draw", "features", "values"],
            )

    sample = (
        rows.filter(draw < share)
        .select(text_col, F.col(lang_col).alias("lang"), F.xxhash64(text_col, id_col).alias("draw"))
        .mapInArrow(features, "lang string, draw long, features array<int>, values array<float>")
        # Twice the expected number bounds the sample before it is fetched, whatever the ids are.
        .orderBy("draw")
        .limit(2 * rows_per_language * len(languages))
        .toArrow()
    )
    for lang, drawn, f, v in zip(*(sample.column(c) for c in sample.column_names)):
        at = f.values.to_numpy()
        row = at, v.values.to_numpy() * inverse[at] * _SCALE, number[lang.as_py()]
        (check if drawn.as_py() % CALIBRATION_PART == 0 else fit).append(row)
    del sample
    weights, bias = fit_ftrl(fit or check, len(languages), penalties or Penalties(), epochs)
    scores = np.array([x @ weights[at] + bias for at, x, _ in check]).reshape(-1, len(languages))
    temperature = fit_temperature(scores, np.array([k for *_, k in check], np.int64))
    # The driver lives on, too.
    del fit, check, scores
    release_memory()
    return Model(languages, weights * inverse[:, None] * _SCALE, bias, temperature)


def _padded(model: Model) -> np.ndarray:
    """The weights, and a row of zeros for n-grams that run over the end of a text."""
    return np.vstack([model.weights, np.zeros(len(model.languages))]).astype(np.float32)


def _scores(texts: list[str | None], model: Model, weights: np.ndarray) -> np.ndarray:
    """The languages' scores of each text before calibration; ``weights`` as :func:`_padded` has them."""
    out = np.zeros((len(texts), len(model.languages)))
    for a, b in _pieces(texts):
        features, first = _grams(texts[a:b])
        lengths = np.diff(first)
        full = lengths > 0
        if not full.any():
            continue
        each = np.take(weights, features[0], axis=0, mode="clip")
        for feature in features[1:]:
            each += np.take(weights, feature, axis=0, mode="clip")
        total = np.add.reduceat(each, first[:-1][full], axis=0, dtype=np.float64)
        grams = sum(np.maximum(lengths - n, 0) for n in range(MAX_N))
        out[a:b][full] = total / grams[full][:, None]
    return out + model.bias


def _predict(shared, id_first: list[str]):
    def run(batches):
        model = shared.value
        weights = _padded(model)
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            texts = batch["_text"].to_pylist()
            p = _softmax(_scores(texts, model, weights) / model.temperature)
            best = p.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in id_first),
                    pa.array([model.languages[k] for k in best], pa.string()),
                    pa.array(p[np.arange(len(best)), best], pa.float64()),
                ],
                names=[*id_first, "_lang", "_score"],
            )
        release_memory()

    return run


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` plus ``lang_pred`` and ``score``.

    Only the text is used, all of it. ``score`` is the calibrated probability of the
    predicted language, 0 for ``und``: a null text, or one without a letter, or any
    text if the model knows no language. Of equally likely languages the first by
    name is taken. Columns of ``docs`` named like a result are replaced.
    """
    spark = docs.sparkSession
    keep = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    if not model.languages:
        return docs.select(
            *(docs[c] for c in keep), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    shared = spark.sparkContext.broadcast(model)
    rows, names = shielded(docs)
    text, kept = rows[names[text_col]], [names[c] for c in keep]
    source = rows.select(*kept, text.alias("_text"), has_letter(text).alias("_letter"))
    passed = [*kept, "_letter"]
    schema = source.select(*passed, F.lit("").alias("_lang"), F.lit(0.0).alias("_score")).schema
    out = source.mapInArrow(_predict(shared, passed), schema)
    return out.select(
        *(F.col(new).alias(c) for c, new in zip(keep, kept)),
        F.when(F.col("_letter"), F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_letter"), F.col("_score")).otherwise(0.0).alias("score"),
    )


def held_out(doc_id: Column) -> Column:
    """One document in four, by its id, is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep: list[str] | None = None,
) -> DataFrame:
    """Trains on the documents of ``docs`` that are not held out and predicts all of them.

    Adds ``held_out``, ``lang_pred`` and ``score``. A document with a null id is not held out, but
    not learned from either.
    """
    learn = docs.filter(docs[id_col].isNotNull() & ~held_out(docs[id_col]))
    model = train(learn, id_col, text_col, lang_col)
    keep = [c for c in (keep or docs.columns) if c != "held_out"]
    flagged = docs.withColumn("held_out", held_out(docs[id_col]))
    return predict(flagged, model, text_col, [*keep, "held_out"])
