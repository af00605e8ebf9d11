"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 512 code points. Each passage is encoded by character classes, word shape, repetition
(of lines and words of earlier passages too) and common words, never by its document's length or other passages to come; a learned layer turns the encoding into a hidden vector, gated attention (tanh gate times sigmoid gate)
weighs the passages, and the weighted vector is scored. Only document labels are used: the attention learns which
passages speak for the label.

Training reads at most `max_labelled` labelled documents, those with the smallest hash of their id (parameter of fit());
their encodings, not their texts, go to the driver. Scoring reads every passage of every document.

Cases: a null or empty text is a bag with one passage of zeros; equal texts have equal scores; null labels are no
labels; without labels of both classes every score is the share of 1 among the labels (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.functions.session import arrow_rows
from leafmill.llm.spotsigs import COMMON

PASSAGE = 512
LOWER, UPPER, DIGIT, SPACE, BREAK, STOP, COMMA, OTHER_LETTER, MARK, SYMBOL = range(10)
N_CLASSES = 10
N_FEATURES = 24


def _class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER_LETTER, dtype=np.int8)
    for i in range(0x110000):
        c = chr(i)
        if c in "\n\r":
            table[i] = BREAK
        elif c.isspace():
            table[i] = SPACE
        elif c in ".!?":
            table[i] = STOP
        elif c in ",;:'\"()-":
            table[i] = COMMA
        elif c.isdigit():
            table[i] = DIGIT
        elif c.islower():
            table[i] = LOWER
        elif c.isupper():
            table[i] = UPPER
        elif c.isalpha():
            table[i] = OTHER_LETTER
        elif c in "#$%&*@|~^_+=<>/\\[]{}":
            table[i] = SYMBOL
        else:
            table[i] = MARK
    return table


_CLASSES = _class_table()


def encode(text: str | None) -> np.ndarray:
    """(passages, N_FEATURES) of a text; the whole text counts."""
    if not text:
        return np.zeros((1, N_FEATURES), dtype=np.float32)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    classes = _CLASSES[codes].astype(np.int64)
    n = len(text)
    count = (n + PASSAGE - 1) // PASSAGE
    where = np.arange(n) // PASSAGE
    shares = np.bincount(where * N_CLASSES + classes, minlength=count * N_CLASSES).reshape(count, N_CLASSES)
    lengths = np.minimum(PASSAGE, n - np.arange(count) * PASSAGE)
    # Neighbours of one class that is no letter, and equal neighbours.
    twice = (codes[1:] == codes[:-1]) & (classes[1:] >= STOP) & (classes[1:] != OTHER_LETTER)
    doubled = np.bincount(where[1:], weights=twice, minlength=count)
    out = np.zeros((count, N_FEATURES), dtype=np.float32)
    out[:, :N_CLASSES] = shares / lengths[:, None]
    out[:, 10] = doubled / lengths
    seen_lines: set[str] = set()
    seen_words: set[str] = set()
    for i in range(count):
        part = text[i * PASSAGE : (i + 1) * PASSAGE]
        words = part.split()
        k = max(1, len(words))
        unique = set(words)
        out[i, 11] = len(unique) / k
        out[i, 12] = min(len(part) / k, 30) / 10
        out[i, 13] = sum(w in COMMON for w in words) / k
        out[i, 14] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / k
        lines = part.split("\n")
        out[i, 15] = sum(line in seen_lines for line in lines) / len(lines)
        seen_lines.update(lines)
        out[i, 16] = min(len(lines), 40) / 10
        out[i, 17] = sum(len(w) == 1 for w in words) / k
        out[i, 18] = sum(len(w) > 14 for w in words) / k
        out[i, 23] = len(unique & seen_words) / max(1, len(unique))
        seen_words |= unique
    letters = shares[:, LOWER] + shares[:, UPPER] + shares[:, OTHER_LETTER]
    out[:, 19] = shares[:, UPPER] / np.maximum(1, letters)
    out[:, 20] = shares[:, SYMBOL] / np.maximum(1, shares[:, SPACE] + 1)
    out[:, 21] = shares[:, STOP] / np.maximum(1, shares[:, SPACE] + 1)
    out[:, 22] = np.log1p(lengths) / 10
    return out


@dataclass
class Model:
    """Weights of the encoder layer, the attention gates and the scorer."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray):
        w = self.w
        sizes = np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ w["We"] + w["be"])
        v = np.tanh(h @ w["V"])
        u = 1 / (1 + np.exp(-np.clip(h @ w["U"], -30, 30)))
        e = np.clip((v * u) @ w["a"], -30, 30)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        att = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(att[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"][0], -30, 30)))
        return p, (sizes, h, v, u, att, z)

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
        return self.forward((np.concatenate(bags) - self.mean) / self.scale, starts)[0].astype(np.float64)


def gradient(model: Model, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean log loss by each weight."""
    w = model.w
    p, (sizes, h, v, u, att, z) = model.forward(x, starts)
    dlogit = (p - y) / len(y)
    g = {"c": z.T @ dlogit, "d": np.array([dlogit.sum()])}
    dz = np.repeat(dlogit[:, None] * w["c"], sizes, axis=0)
    datt = (dz * h).sum(1)
    dh = att[:, None] * dz
    de = att * (datt - np.repeat(np.add.reduceat(att * datt, starts), sizes))
    g["a"] = (v * u).T @ de
    dvu = de[:, None] * w["a"]
    dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
    g["V"], g["U"] = h.T @ dv, h.T @ du
    dh = (dh + dv @ w["V"].T + du @ w["U"].T) * (1 - h * h)
    g["We"], g["be"] = x.T @ dh, dh.sum(0)
    return g


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, steps: int = 250, rate: float = 0.02, decay: float = 1e-3, seed: int = 11) -> Model:
    """Full-batch Adam on the log loss."""
    y = np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, float(y.mean()) if len(y) else 0.5)
    x = np.concatenate(bags).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
    rng = np.random.default_rng(seed)
    shape = {"We": (N_FEATURES, hidden), "be": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "a": (gate,), "c": (hidden,), "d": (1,)}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in ("be", "d") else np.zeros(s) for k, s in shape.items()}
    model = Model(mean, scale, w)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s2 = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        g = gradient(model, x, starts, y)
        for k in w:
            grad = g[k] + decay * w[k] * (k not in ("be", "d"))
            m[k] = 0.9 * m[k] + 0.1 * grad
            s2[k] = 0.999 * s2[k] + 0.001 * grad * grad
            w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s2[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id):
    """Whether a row is kept from learning: crc32 of the id as text is divisible by 5."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _encodings(batches):
    for batch in batches:
        bags = [encode(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([b.tobytes() for b in bags], pa.binary())], ["doc_id", "label", "bag"]
        )


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_labelled: int = 4000, **how) -> Model:
    """Model of the labelled documents of docs (at most max_labelled, by hash of the id).

    One label of an id that has several counts, the smallest. All rows of an id count once for each text; the encodings
    (24 numbers for 512 characters) of the sample go to the driver.
    """
    arrow_rows(docs.sparkSession)
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sample = texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "label").distinct()
    rows = sample.mapInArrow(_encodings, "doc_id long, label int, bag binary").toPandas().sort_values(["doc_id", "bag"])
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, N_FEATURES) for b in rows["bag"]]
    return train(bags, rows["label"].to_numpy(), **how)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with a column score_col: 0 to 1, higher for better texts. A column of that name is replaced."""
    arrow_rows(docs.sparkSession)
    names = [c for c in docs.columns if c != score_col]
    docs = docs.select(*names)
    at = names.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for batch in batches:
            scores = model.scores([encode(t) for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)
