"""Language identification by a byte convolutional network trained in numpy.

Filters of several widths run over a text's UTF-8 bytes (ASCII letters lower-cased, digits made equal).
Each filter's largest answer within a window of fixed length is kept, and a softmax layer turns the kept
answers into language probabilities; a text's probabilities are the mean over its windows' log
probabilities. A filter over one-hot bytes is a table of weights by position and byte, so applying it is
a sum of table rows, and the first two positions of all filters are looked up together by byte pair.

Scale: the network is trained on the driver from at most ``SAMPLE`` documents of at most ``PER_DOC``
windows each (a documented bound: SAMPLE * PER_DOC * (WINDOW + 3) bytes). Scoring is row by row in every
task, over all windows of the whole text; no shuffle, and what is broadcast is the network's fixed size.

Defined results: a text that is null or has no letter is ``und`` with score 0; ties between languages
go to the smaller name; without any labelled text every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import append_struct, as_bytes, free_name, held_out, rows_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE = 8_000
PER_DOC = 2
EPOCHS = 6
UNKNOWN = "und"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_AHEAD = max(WIDTHS) - 1  # bytes that a filter may read beyond its window

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    weights: np.ndarray  # (all filters, languages)
    bias: np.ndarray

    def tables(self):
        """Rows by byte pair for the first two positions of all filters, and what is added further on."""
        pair = np.concatenate([(f[0][:, None, :] + f[1][None, :, :]).reshape(65536, FILTERS) for f in self.filters], axis=1)
        return pair.astype(np.float32)

    def window_logs(self, data: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Log probabilities of each window of ``data``: whole windows followed by _AHEAD bytes."""
        n = len(data) - _AHEAD
        pooled = []
        for start in range(0, n, 512 * WINDOW):
            part = data[start:min(start + 512 * WINDOW, n) + _AHEAD].astype(np.int32)
            m = len(part) - _AHEAD
            answers = pair[(part[:m] << 8) | part[1:m + 1]]
            for k, f in enumerate(self.filters):
                for step in range(2, len(f)):
                    answers[:, k * FILTERS:(k + 1) * FILTERS] += f[step][part[step:m + step]]
            pooled.append(answers.reshape(-1, WINDOW, answers.shape[1]).max(axis=1))
        hidden = np.maximum(np.concatenate(pooled), 0)
        return _log_softmax(hidden @ self.weights + self.bias)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each filled up with zeros to whole windows; and each window's text number.

    At least _AHEAD zeros end a text, so that no filter reads into the next one.
    """
    counts = [(len(t) + _AHEAD + WINDOW - 1) // WINDOW for t in texts]
    joined = b"".join(t.translate(_FOLD).ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts, strict=True)) + b"\0" * _AHEAD
    return np.frombuffer(joined, np.uint8), np.repeat(np.arange(len(texts)), counts)


def train(windows: np.ndarray, targets: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit the network to windows (n, WINDOW + _AHEAD) of folded bytes by Adam; classes weigh alike."""
    rng = np.random.default_rng(seed)
    n_lang, total = len(languages), FILTERS * len(WIDTHS)
    filters = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    weights = rng.normal(0, 0.1, (total, n_lang)).astype(np.float32)
    bias = np.zeros(n_lang, np.float32)
    share = np.bincount(targets, minlength=n_lang)
    by_class = (len(targets) / (n_lang * np.maximum(share, 1))).astype(np.float32)
    params = [*filters, weights, bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    columns = np.arange(FILTERS)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // 64)):
            data, size = windows[rows], len(rows)
            at, pooled = [], []
            for f in filters:
                answers = sum(f[k][data[:, k:k + WINDOW]] for k in range(len(f)))
                best = answers.argmax(axis=1)
                at.append(best)
                pooled.append(np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0, :])
            raw = np.concatenate(pooled, axis=1)
            hidden = np.maximum(raw, 0)
            wrong = np.exp(_log_softmax(hidden @ weights + bias))
            wrong[np.arange(size), targets[rows]] -= 1
            wrong *= by_class[targets[rows]][:, None] / size
            back = (wrong @ weights.T) * (raw > 0)
            slopes = []
            for k, f in enumerate(filters):
                slope = np.zeros_like(f)
                own = back[:, k * FILTERS:(k + 1) * FILTERS]
                for p in range(len(f)):
                    seen = data[np.arange(size)[:, None], at[k] + p]
                    np.add.at(slope[p], (seen, columns[None, :]), own)
                slopes.append(slope)
            slopes += [hidden.T @ wrong + 1e-4 * weights, wrong.sum(axis=0)]
            step += 1
            for p, slope, a, b in zip(params, slopes, first, second, strict=True):
                a += 0.1 * (slope - a)
                b += 0.001 * (slope * slope - b)
                p -= 0.01 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return Network(languages, filters, weights, bias)


def training_windows(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Windows (lang, bytes) of a bounded sample of labelled documents outside the held-out fifth.

    The sample is the ``sample`` rows of the smallest hash; places within a text come from its hash.
    """
    def make():
        def work(batch):
            langs, out = [], []
            for lang, text, mix in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text")).to_pylist(),
                                       batch.column("mix").to_pylist(), strict=True):
                count = (len(text) + WINDOW - 1) // WINDOW
                for k in {(mix >> 8 * i) % count for i in range(PER_DOC)}:
                    cut = text[k * WINDOW:(k + 1) * WINDOW + _AHEAD]
                    out.append(cut.translate(_FOLD).ljust(WINDOW + _AHEAD, b"\0"))
                    langs.append(lang)
            yield {"lang": langs, "data": out}
        return work

    mix = F.xxhash64(F.col(id_col), F.lit("language"))
    known = (docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
             .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), mix.alias("mix"), F.xxhash64(text_col).alias("tie")))
    # the sample's last hash first, so that texts themselves are never sorted
    last = known.select("mix", "tie").orderBy("mix", "tie").limit(sample).agg(F.max(F.struct("mix", "tie"))).first()[0]
    if last is None:
        return rows_of(known.where(F.lit(False)), "lang string, data binary", make)
    within = (F.col("mix") < last["mix"]) | ((F.col("mix") == last["mix"]) & (F.col("tie") <= last["tie"]))
    return rows_of(known.where(within), "lang string, data binary", make)


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """The network, or None where nothing is labelled."""
    rows = training_windows(docs, sample, id_col, text_col, lang_col).limit(2 * sample * PER_DOC).toArrow()
    # any order of tasks gives the same network
    pairs = sorted(zip(rows.column("lang").to_pylist(), rows.column("data").to_pylist(), strict=True))
    if not pairs:
        return None
    languages = sorted({lang for lang, _ in pairs})
    number = {lang: i for i, lang in enumerate(languages)}
    data = np.frombuffer(b"".join(d for _, d in pairs), np.uint8).reshape(len(pairs), -1)
    return train(data, np.array([number[lang] for lang, _ in pairs]), languages)


def identify(docs: DataFrame, network: Network | None, text_col: str = "text", into: str = "language") -> DataFrame:
    """Rows of ``docs`` with a struct: lang_pred and the probability it was given."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    lettered = free_name(docs, "has_letter")

    def make():
        net = shared.value
        pair = net.tables() if net else None

        def work(batch):
            texts = [t or b"" for t in as_bytes(batch.column(text_col)).to_pylist()]
            known = [i for i, yes in enumerate(batch.column(lettered).to_pylist()) if yes and net]
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                data, owner = lay_out([texts[i] for i in known])
                logs = net.window_logs(data, pair).astype(np.float64)
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                mean = np.add.reduceat(logs, starts, axis=0) / np.diff(np.r_[starts, len(owner)])[:, None]
                chance = np.exp(_log_softmax(mean))
                for i, best, row in zip(known, chance.argmax(axis=1), chance, strict=True):
                    langs[i], scores[i] = net.languages[best], float(min(1.0, row[best]))
            return {"lang_pred": langs, "score": scores}
        return work

    marked = docs.withColumn(lettered, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    return append_struct(marked, into, RESULT, make, text_col).drop(lettered)
