"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own and of its neighbours; a chain of two states, bad and good, gives each line
its marginal by forward-backward; the marginals, weighted by line length, make the document's quality.
A logistic curve fitted on the training documents turns that into a probability.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Labelled documents that the model is fitted on at most: those of the smallest hash.
TRAIN_ROWS = 3000
EPOCHS, RATE, PENALTY = 120, 0.08, 1e-4
#: A line is cut into pieces of this many characters, so that a text without line ends is a chain too.
PIECE_CHARS = 400
OWN = 12
FEATURES = 3 * OWN + 1
SYMBOLS = re.compile(r"[#*$%&|<>!{}\[\]\\~^=@_]")


def pieces(text: str) -> list[str]:
    out = []
    for line in text.split("\n"):
        if not line.strip():
            continue
        while len(line) > PIECE_CHARS:
            end = line.find(" ", PIECE_CHARS - 40, PIECE_CHARS)
            end = end if end > 0 else PIECE_CHARS
            out.append(line[:end])
            line = line[end:]
        if line.strip():
            out.append(line)
    return out


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES, lengths): a bias, then each line's own features, the line before's and the line after's."""
    lines = pieces(text)
    n = len(lines)
    own = np.zeros((n + 2, OWN), np.float32)
    seen: set[str] = set()
    earlier: set[str] = set()
    total = len(text.split())
    for i, line in enumerate(lines, 1):
        words = line.split()
        chars = max(1, sum(map(len, words)))
        lower = [w.lower() for w in words]
        own[i] = (
            len(SYMBOLS.findall(line)) / chars,
            sum(map(str.isupper, line)) / chars,
            sum(map(str.isdigit, line)) / chars,
            min(3.0, chars / max(1, len(words)) / 6),
            len(set(lower)) / max(1, len(words)),
            sum(w in earlier for w in lower) / max(1, len(words)),
            line.strip() in seen,
            min(1.0, len(words) / 40),
            sum(c in ".,;:?" for c in line) / chars,
            sum(map(str.isalpha, line)) / chars,
            min(1.0, np.log1p(total) / 10),
            total < 50,
        )
        seen.add(line.strip())
        earlier.update(lower)
    return np.hstack([np.ones((n, 1), np.float32), own[1:-1], own[:-2], own[2:]]), np.array([len(x) for x in lines], np.float64)


@dataclass(frozen=True)
class Model:
    weights: tuple  # of a good line, over FEATURES
    moves: tuple  # 2 x 2 scores of a step between states
    curve: tuple  # slope and shift of the logistic curve
    empty: float  # the score of a text without lines

    def score(self, text: str) -> float:
        x, lengths = features(text)
        if not len(x):
            return self.empty
        good = forward_backward([x @ np.array(self.weights)], np.array(self.moves))[0][0]
        return float(sigmoid(self.curve[0] * (good @ lengths / lengths.sum()) + self.curve[1]))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def forward_backward(scores: list[np.ndarray], moves: np.ndarray):
    """Marginals of the good state for each chain, and the expected steps over all chains (2 x 2).

    Chains are padded to a block; a step is taken for all chains that still run."""
    n, longest = len(scores), max(map(len, scores))
    size = np.array([len(s) for s in scores])
    node = np.ones((n, longest, 2))
    for i, s in enumerate(scores):
        # a factor common to both states cancels
        node[i, : len(s), 1] = np.exp(np.clip(s, -30, 30) / 2)
        node[i, : len(s), 0] = np.exp(-np.clip(s, -30, 30) / 2)
    step = np.exp(np.clip(moves, -10, 10))
    ahead, back = np.zeros((n, longest, 2)), np.ones((n, longest, 2))
    ahead[:, 0] = node[:, 0] / node[:, 0].sum(1, keepdims=True)
    for t in range(1, longest):
        a = ahead[:, t - 1] @ step * node[:, t]
        ahead[:, t] = a / a.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        b = (back[:, t + 1] * node[:, t + 1]) @ step.T
        b /= b.sum(1, keepdims=True)
        back[:, t] = np.where((t + 1 < size)[:, None], b, 1.0)
    both = ahead * back
    good = both[..., 1] / both.sum(2)
    pair = ahead[:, :-1, :, None] * step * (node[:, 1:] * back[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    inside = np.arange(longest - 1)[None, :] + 1 < size[:, None]
    return [g[:s] for g, s in zip(good, size)], pair[inside].sum(0)


def fit(chains: list[np.ndarray], lengths: list[np.ndarray], labels: list[int]) -> Model:
    """Maximum likelihood by Adam, classes weighing the same; each line of a document has the document's label.

    Without texts of both classes the model is the share of good ones."""
    y = np.array(labels, float)
    with_lines = [i for i, c in enumerate(chains) if len(c)]
    blank = [i for i, c in enumerate(chains) if not len(c)]
    prior = float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
    empty = float((y[blank].sum() + 0.2) / (len(blank) + 1)) if len(y) else prior
    if len({labels[i] for i in with_lines}) < 2:
        return Model((0.0,) * FEATURES, ((0.0, 0.0), (0.0, 0.0)), (0.0, float(np.log(prior / (1 - prior)))), empty)
    with_lines.sort(key=lambda i: len(chains[i]))
    blocks = [with_lines[i : i + 256] for i in range(0, len(with_lines), 256)]
    share = y[with_lines].mean()
    w, moves = np.zeros(FEATURES), np.zeros((2, 2))
    first, second = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    for epoch in range(1, EPOCHS + 1):
        gradient, lines = np.zeros(FEATURES + 4), 0.0
        for block in blocks:
            # rare class and common class pull alike; a long document counts as many lines, up to a point
            for label in (0, 1):
                part = [i for i in block if labels[i] == label]
                if not part:
                    continue
                pull = 0.5 / (share if label else 1 - share)
                good, steps = forward_backward([chains[i] @ w for i in part], moves)
                for i, g in zip(part, good):
                    gradient[:FEATURES] += pull * (chains[i].T @ (label - g)) / len(g) ** 0.5
                seen = np.zeros((2, 2))
                seen[label, label] = sum(len(chains[i]) - 1 for i in part)
                gradient[FEATURES:] += pull * (seen - steps).ravel() * 0.1
                lines += pull * sum(len(chains[i]) ** 0.5 for i in part)
        gradient = gradient / lines - PENALTY * np.r_[w, moves.ravel()]
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        change = RATE * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.999**epoch)) + 1e-8)
        w, moves = w + change[:FEATURES], moves + change[FEATURES:].reshape(2, 2)
        moves = np.clip(moves, -2, 2)
    quality = np.zeros(len(chains))
    for block in blocks:
        for i, g in zip(block, forward_backward([chains[i] @ w for i in block], moves)[0]):
            quality[i] = g @ lengths[i] / lengths[i].sum()
    # the curve, by Newton's method with a small penalty
    x = np.c_[quality[with_lines], np.ones(len(with_lines))]
    curve = np.zeros(2)
    for _ in range(30):
        p = sigmoid(x @ curve)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        curve = curve + np.linalg.solve(hessian, x.T @ (y[with_lines] - p) - 1e-2 * curve)
    return Model(tuple(w), tuple(map(tuple, moves)), tuple(curve), empty)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on TRAIN_ROWS labelled texts at most, outside the held-out fifth; only their features reach the driver."""
    small_batches(docs.sparkSession, 200, "2m")
    open_ = labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).filter(F.crc32(F.col(id_col).cast("string")) % 5 != 0)
    chosen = open_.groupBy(id_col).agg(F.max("quality").alias("quality")).orderBy(F.xxhash64(F.col(id_col)), id_col).limit(TRAIN_ROWS)
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(F.col(id_col).cast("long").alias("id"), F.col("quality").cast("int").alias("quality"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            out = []
            for i, q, t in zip(*(c.to_pylist() for c in b.columns)):
                x, lengths = features(t or "")
                out.append((i, q, x.tobytes(), lengths.tobytes()))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["id", "quality", "x", "lengths"])

    rows = sorted(texts.mapInArrow(run, "id long, quality int, x binary, lengths binary").toLocalIterator(), key=lambda r: (r["id"], r["x"]))
    chains = [np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, FEATURES).astype(float) for r in rows]
    return fit(chains, [np.frombuffer(bytes(r["lengths"])) for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, labels: DataFrame, cutoff: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every whole text.

    Null texts are empty and, like texts of white space, get the share of good ones among such labelled texts.
    A null id is not held out. Rows out are rows in; labels whose id or quality is null aren't used, and of
    several for one id the higher counts. Without labels of both classes all scores are the share of good ones.
    """
    model = train(docs, labels, id_col, text_col)
    small_batches(docs.sparkSession, 200, "2m")
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            scores = [model.score(t or "") for t in b.column(1).to_pylist()]
            out = [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]
            yield pa.record_batch([b.column(0), pa.array(out), pa.array(scores, pa.float64()), pa.array([int(s >= cutoff) for s in scores], pa.int32())], [id_col, "held_out", "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: Model, cutoff: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text scores cutoff or more; no shuffle."""
    small_batches(docs.sparkSession, 200, "2m")
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([model.score(t or "") >= cutoff for t in b.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
