"""Language identification: a byte convolutional network, trained in numpy, applied to fixed-length byte windows.

Network. Bytes are embedded, filters of ``WIDTHS`` bytes slide over a window of ``WINDOW`` bytes, rectified and
max-pooled over the window, and a softmax layer gives the languages. Training (Adam on cross-entropy, with a fixed seed)
runs on the driver over a bounded sample of every language: at most ``SAMPLE_DOCS`` documents of each, and of all
languages together ``SAMPLE_TOTAL``, so beyond 64 languages each gives fewer, down to one. They are chosen by a hash of
their ids among those not held out that have a letter, with ``SAMPLE_WINDOWS`` windows spread over each. What the driver
gets grows with the number of languages only where there are more of them than ``SAMPLE_TOTAL``. Labels, sources and ids
are never inputs of a prediction.

Prediction. Every text is cut into windows from its first byte to its last (the last is padded), windows of many texts
are evaluated in one batch, and a text's probabilities are the byte-weighted mean over its windows. Filters are applied
as sums of rows of byte-pair tables, so a window costs five table reads a byte. No shuffle; memory is bounded by
``BATCH`` windows.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any labelled text all are
``und``; with one language it is that one; a row without a doc_id is not held out; repeated rows are predicted row by
row (and sampled by id); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightaudit.llm.common import table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
SAMPLE_DOCS = 500
SAMPLE_WINDOWS = 6
SAMPLE_TOTAL = 32_000
EPOCHS = 6
BATCH = 2048
HELD_OUT_OF = 5


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's windows (zero-padded) and the number of its bytes in each."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = -(-len(raw) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(raw)] = raw
    sizes = np.full(n, WINDOW)
    if n:
        sizes[-1] = len(raw) - (n - 1) * WINDOW
    return out.reshape(n, WINDOW), sizes


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class ByteCnn:
    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.params = {"embed": rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)}
        for w in WIDTHS:
            self.params[f"filter{w}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS)).astype(np.float32)
            self.params[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.params["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.params["out_bias"] = np.zeros(len(languages), np.float32)

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.params["out"] + self.params["out_bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.params, len(x)
        e = p["embed"][x]
        pooled, best = [], {}
        for w in WIDTHS:
            patches = np.concatenate([e[:, j:WINDOW - w + 1 + j] for j in range(w)], axis=2)
            act = patches @ p[f"filter{w}"] + p[f"bias{w}"]
            best[w] = act.argmax(axis=1)
            pooled.append(np.maximum(act.max(axis=1), 0))
        h = np.concatenate(pooled, axis=1)
        d = self._softmax(h)
        d[np.arange(n), y] -= 1
        d /= n
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["out_bias"] = h.T @ d, d.sum(axis=0)
        dh = (d @ p["out"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            own = dh[:, i * FILTERS:(i + 1) * FILTERS]
            at = best[w][:, :, None] + np.arange(w)  # (n, filters, w): bytes under each winning place
            under = x[np.arange(n)[:, None, None], at]
            patch = p["embed"][under].reshape(n, FILTERS, w * EMBEDDING)
            g[f"filter{w}"] = np.einsum("nf,nfd->df", own, patch)
            g[f"bias{w}"] = own.sum(axis=0)
            back = (own[:, :, None] * p[f"filter{w}"].T[None]).reshape(n, FILTERS, w, EMBEDDING)
            np.add.at(g["embed"], under.reshape(-1), back.reshape(-1, EMBEDDING))
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> "ByteCnn":
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v = {k: np.zeros_like(a) for k, a in self.params.items()}
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
                step += 1
                for k, g in self.gradients(x[part], y[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.params[k] -= 3e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-7)
        return self

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width, (place, table) terms: byte pairs, and a single byte for what is left of an odd width."""
        out = []
        for w in WIDTHS:
            each = [self.params["embed"] @ self.params[f"filter{w}"][j * EMBEDDING:(j + 1) * EMBEDDING] for j in range(w)]
            each[0] = each[0] + self.params[f"bias{w}"]
            terms = [(j, (each[j + 1][:, None, :] + each[j][None, :, :]).reshape(65536, FILTERS))  # second byte is high
                     for j in range(0, w - 1, 2)]
            if w % 2:
                terms.append((w - 1, each[w - 1]))
            out.append(terms)
        return out

    def predict(self, x: np.ndarray, tables: list) -> np.ndarray:
        """Probabilities of the languages for each window."""
        out = np.empty((len(x), len(self.languages)), np.float32)
        for a in range(0, len(x), 64):
            part = x[a:a + 64]
            pairs = part[:, :-1].astype(np.intp) | (part[:, 1:].astype(np.intp) << 8)
            pooled = []
            for w, terms in zip(WIDTHS, tables):
                n = WINDOW - w + 1
                act = None
                for j, t in terms:
                    rows = t[(pairs if len(t) > 256 else part)[:, j:j + n]]
                    act = rows if act is None else np.add(act, rows, out=act)
                pooled.append(np.maximum(act.max(axis=1), 0))
            out[a:a + 64] = self._softmax(np.concatenate(pooled, axis=1))
        return out


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lang, rows = [], []
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if has_letter(text):
                x, _ = windows_of(text)
                for i in np.unique(np.linspace(0, len(x) - 1, SAMPLE_WINDOWS).round().astype(int)):
                    lang.append(label)
                    rows.append(x[i].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(rows, pa.binary())], names=["lang", "x"])


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_total: int = SAMPLE_TOTAL) -> ByteCnn:
    """A network for all non-null languages of the documents with an id and a letter that are not held out."""
    known = (docs.select("doc_id", "lang", "text").filter("doc_id IS NOT NULL AND lang IS NOT NULL")
             .filter(F.col("text").rlike(r"\p{L}")).filter(~held_out()))
    # Which documents: from ids and labels only; each task hands on no more than the bound.
    ranked = known.select("doc_id", "lang").withColumn("r", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))).filter(F.col("r") <= sample_docs)
    each = ranked.filter("r = 1").agg(F.count("*").alias("languages")).select(
        F.greatest(F.floor(F.lit(sample_total) / F.greatest("languages", F.lit(1))), F.lit(1)).alias("each"))
    chosen = ranked.crossJoin(F.broadcast(each)).filter("r <= each").select("doc_id").distinct()  # one row
    # The chosen ids are bounded by the sample (or one for each language), so the texts stay where they are read.
    rows = (known.join(F.broadcast(chosen), "doc_id", "left_semi").select("text", "lang")
            .mapInArrow(_sample_windows, "lang string, x binary").collect())  # bounded by the sample
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    languages = sorted({r["lang"] for r in rows})
    net = ByteCnn(languages)
    if len(languages) > 1:
        place = {name: i for i, name in enumerate(languages)}
        net.fit(np.stack([np.frombuffer(r["x"], np.uint8) for r in rows]), np.array([place[r["lang"]] for r in rows]))
    return net


def _predicted(batches: Iterator[pa.RecordBatch], net: ByteCnn) -> Iterator[pa.RecordBatch]:
    tables = net.tables() if net.languages else []
    names = ["doc_id", "held_out", "lang_pred", "score"]
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            texts = b.column(2).to_pylist()
            total = np.zeros((len(texts), len(net.languages)))
            read = np.array([has_letter(t) for t in texts], bool) if net.languages else np.zeros(len(texts), bool)
            held, owners, weights, n = [], [], [], 0

            def evaluate() -> None:
                p = net.predict(np.concatenate(held), tables).astype(np.float64)
                np.add.at(total, np.concatenate(owners), p * np.concatenate(weights)[:, None])

            for i in np.flatnonzero(read):
                x, sizes = windows_of(texts[i])
                for a in range(0, len(x), BATCH):
                    held.append(x[a:a + BATCH])
                    owners.append(np.full(len(held[-1]), i))
                    weights.append(sizes[a:a + BATCH])
                    n += len(held[-1])
                    if n >= BATCH:
                        evaluate()
                        held, owners, weights, n = [], [], [], 0
            if held:
                evaluate()
            total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-300)
            best = total.argmax(axis=1) if net.languages else np.zeros(len(texts), int)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1),
                pa.array([net.languages[k] if r else "und" for k, r in zip(best, read)], pa.string()),
                pa.array([min(1.0, float(total[i, best[i]])) if read[i] else 0.0 for i in range(len(texts))], pa.float64())],
                names=names)


def identify(docs: DataFrame, net: ByteCnn) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        lambda it: _predicted(it, net), "doc_id long, held_out boolean, lang_pred string, score double")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


QUERIES = {"op10_language_id": op10_language_id}
