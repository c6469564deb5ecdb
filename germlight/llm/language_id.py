"""Language identification with a small byte convolutional network, trained here in numpy.

Bytes are embedded, filters of several widths slide over them, each filter keeps its maximum in a window, and a softmax layer ranks the
languages. A whole text is cut into windows of WINDOW bytes (neighbours share the widest filter's reach, so no byte sequence is cut in two); the
windows' log probabilities are averaged, weighted by their length. Batches have a fixed number of windows, so memory doesn't follow text length.

Defined cases: a null text, or one without a letter, is `und` with score 0; repeated rows are predicted each on its own; documents of null
language are never learnt from; if no language can be learnt (an empty table), every prediction is `und`; a null doc_id is never learnt from
and not held out; columns other than the named ones are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import fold, held_out, table

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 16, 8
#: Windows in a forward pass.
BATCH = 128
#: Bounds of the training sample: so many texts of each language, those of the least hash, and so many together (but one of each language).
TRAIN_PER_LANGUAGE, TRAIN = 400, 80_000
EPOCHS, RATE, SEED = 12, 0.01, 11


class ByteConvNet:
    """Embedding, convolutions of WIDTHS, ReLU, max over the window, softmax."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        n = FILTERS * len(WIDTHS)
        self.p = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "b": np.zeros(n), "v": rng.normal(0, n**-0.5, (n, len(languages))), "c": np.zeros(len(languages))}
        self.p |= {f"w{k}": rng.normal(0, (k * EMBEDDING) ** -0.5, (k * EMBEDDING, FILTERS)) for k in WIDTHS}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def _columns(self, x: np.ndarray, k: int) -> np.ndarray:
        """(windows, positions, k * EMBEDDING) of embedded bytes x."""
        b, t, e = x.shape
        view = np.lib.stride_tricks.as_strided(x, (b, t - k + 1, k * e), (x.strides[0], x.strides[1], x.strides[2]))
        return view

    def _pooled(self, bytes_: np.ndarray) -> tuple[np.ndarray, list, np.ndarray]:
        x = np.ascontiguousarray(self.p["e"][bytes_])
        best, where = [], []
        for k in WIDTHS:
            y = np.matmul(self._columns(x, k), self.p[f"w{k}"])
            where.append(y.argmax(1) if self.training else None)
            best.append(y.max(1))
        return np.concatenate(best, 1) + self.p["b"], where, x

    training = False

    def log_probabilities(self, bytes_: np.ndarray) -> np.ndarray:
        h = np.maximum(self._pooled(bytes_)[0], 0)
        z = h @ self.p["v"] + self.p["c"]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def train(self, bytes_: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> None:
        """Adam on the cross entropy, classes weighted alike."""
        rng, self.training = np.random.default_rng(SEED + 1), True
        weight = (1 / np.maximum(np.bincount(labels, minlength=len(self.languages)), 1))[labels]
        weight = (weight / weight.mean()).astype(np.float32)
        m, v, step = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        for _ in range(epochs):
            order = rng.permutation(len(bytes_))
            for at in range(0, len(order), 64):
                rows, step = order[at : at + 64], step + 1
                for k, g in self._gradient(bytes_[rows], labels[rows], weight[rows]).items():
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        self.training = False

    def _gradient(self, bytes_: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        a, where, x = self._pooled(bytes_)
        h, n = np.maximum(a, 0), len(y)
        z = h @ self.p["v"] + self.p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q *= weight[:, None] / n
        g = {"v": h.T @ q, "c": q.sum(0)}
        d = (q @ self.p["v"].T) * (a > 0)
        g["b"], de = d.sum(0), np.zeros_like(self.p["e"])
        for j, k in enumerate(WIDTHS):
            dk = d[:, j * FILTERS : (j + 1) * FILTERS]
            cols = self._columns(x, k)[np.arange(n)[:, None], where[j]]  # (n, FILTERS, k * EMBEDDING): what each filter's maximum saw
            g[f"w{k}"] = np.einsum("nf,nfe->ef", dk, cols)
            dx = (dk[:, :, None] * self.p[f"w{k}"].T[None]).reshape(n, FILTERS, k, EMBEDDING)
            for i in range(k):
                np.add.at(de, bytes_[np.arange(n)[:, None], where[j] + i], dx[:, :, i])
        g["e"] = de
        return g


def windows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All of data as rows of WINDOW bytes, the last padded with zeros, and their lengths."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(data) - max(WIDTHS) + 1) // step))
    flat = np.zeros((n - 1) * step + WINDOW, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    rows = np.lib.stride_tricks.as_strided(flat, (n, WINDOW), (step, 1))
    return rows, np.minimum(WINDOW, len(data) - np.arange(n) * step)


@lru_cache(maxsize=1)
def _letter_search():
    import regex

    return regex.compile(r"\p{L}").search


def letter(text: str) -> bool:
    """Whether text has a letter; fractions, raised digits and the like are none."""
    return _letter_search()(text) is not None


def predict(model: ByteConvNet, texts: list[str | None]) -> list[tuple[str, float]]:
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    if not model.languages:
        return out
    total = np.zeros((len(texts), len(model.languages)))
    owner, rows, weights = [], [], []

    def flush() -> None:
        if rows:
            logs = model.log_probabilities(np.concatenate(rows)) * np.concatenate(weights)[:, None]
            np.add.at(total, np.concatenate(owner), logs)
            owner.clear(), rows.clear(), weights.clear()

    lengths, pending = np.zeros(len(texts)), 0
    for i, text in enumerate(texts):
        if text is None or not letter(text):
            continue
        r, w = windows(text.encode("utf-8", "replace"))
        lengths[i] = w.sum()
        for at in range(0, len(r), BATCH):
            part = r[at : at + BATCH]
            rows.append(part), owner.append(np.full(len(part), i)), weights.append(w[at : at + BATCH])
            pending += len(part)
            if pending >= BATCH:
                flush()
                pending = 0
    flush()
    for i in np.flatnonzero(lengths):
        mean = total[i] / lengths[i]
        p = np.exp(mean - mean.max())
        k = int(p.argmax())
        out[i] = (model.languages[k], float(p[k] / p.sum()))
    return out


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """(language, bytes as text) of at most TRAIN_PER_LANGUAGE distinct texts of each language, TRAIN at most together but one of each: those of the least
    hash. One window each, at a place that depends on the hash."""
    h = F.xxhash64(F.col(text_col))
    own = docs.where((fold(F.col(id_col)) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    at = (F.pmod(h, F.greatest(F.length(text_col) - WINDOW // 2, F.lit(1)).cast("long")) + 1).cast("int")
    one = own.select(F.col(lang_col).alias("lang"), h.alias("h"), F.col(text_col).substr(at, F.lit(WINDOW)).alias("part"))
    # Copies share a hash: what counts is how many there are, which is known well enough, however many rows a text has.
    languages = one.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min(F.struct("h", "part"))["part"].alias("part")).collect()  # one row for each language
    each = max(1, min(TRAIN_PER_LANGUAGE, TRAIN // max(1, len(languages))))
    # Hashes below this are about twice as many as wanted, so few rows leave their tasks, however many tasks there are.
    limits = [(r["lang"], min(-(2**63) + 2**64 * 2 * each // max(1, r["n"]), 2**63 - 1)) for r in languages]
    below = one.join(F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, most long")), "lang").where("h <= most")
    distinct = below.groupBy("lang", "h").agg(F.min("part").alias("part"))
    chosen = distinct.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct("h", "part"))), 1, each)["part"].alias("parts"))
    sample = {r["lang"]: [r["part"]] for r in languages} | {r["lang"]: r["parts"] for r in chosen.collect()}  # a language of few distinct texts has one at least
    return [(lang, p) for lang in sorted(sample) for p in sample[lang]]


def train(sample: list[tuple[str, str]]) -> ByteConvNet:
    languages = sorted({lang for lang, _ in sample})
    model = ByteConvNet(languages)
    if languages:
        # Each window once whole and once cut short, for the short texts.
        both = [(lang, cut.encode("utf-8", "replace")) for lang, part in sample for cut in (part, part[: 8 + len(part) % 40])]
        x = np.zeros((len(both), WINDOW), np.uint8)
        for i, (_, data) in enumerate(both):
            x[i, : min(len(data), WINDOW)] = np.frombuffer(data[:WINDOW], np.uint8)
        model.train(x, np.array([languages.index(lang) for lang, _ in both]))
    return model


def identify(docs: DataFrame, model: ByteConvNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred and score of every row; a narrow plan."""

    @F.pandas_udf("lang_pred string, score double")
    def each(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(model, list(texts)), columns=["lang_pred", "score"])

    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), each(F.col(text_col)).alias("_p")).select(id_col, "held_out", "_p.lang_pred", "_p.score")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(training_sample(docs)))
