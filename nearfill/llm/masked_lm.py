"""Masked pseudo-likelihood of documents under a bidirectional window network.

Words (``[^\\x20\\x09-\\x0D]+``, ASCII lower case) are hashed into ``VOCABULARY``
tokens.  The network predicts a token from the two on its left and the two on
its right: the embeddings, scaled per place, are summed and squashed, and two
softmax layers give the token's group and, given the group, its member.  A
document's score is the sum over all its tokens of the log probability given
both sides.

Training runs in ``ROUNDS`` over all documents: in each, every task starts from the
shared weights, masks one token of every four (of every n with n rounds; which one
is hashed from the place and turns with the round, so that each token is a target
once and each round sees all columns of a periodic text), descends in numpy over
its own documents, and sends its weights with the number of tokens seen; their
weighted mean is the next start.  The averages are summed per weight
before and after the shuffle, so what is gathered grows with the number of tasks
and only ``PARAMETERS`` numbers reach the driver.

Defined results: a null or empty text has 0 tokens, log likelihood 0, and a null
mean and perplexity; a document's score depends on its text and the model alone,
so repeated rows get equal scores; a null key stays null; an empty table gives an
empty table (its model is the untrained one).  Columns other than key and text are
not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes

GROUPS = 32
VOCABULARY = GROUPS * GROUPS
WIDTH = 16
PLACES = (-2, -1, 1, 2)
ROUNDS = 4
BATCH = 2048
RATE = 0.15
_EDGE = VOCABULARY  # stands beyond a text's first and last word
_SHAPES = {
    "embed": (VOCABULARY + 1, WIDTH), "place": (len(PLACES), WIDTH), "shift": (WIDTH,),
    "group": (WIDTH, GROUPS), "group_shift": (GROUPS,),
    "member": (WIDTH, GROUPS), "member_shift": (GROUPS, GROUPS),
}
PARAMETERS = sum(int(np.prod(s)) for s in _SHAPES.values())

Weights = dict[str, np.ndarray]


def unflatten(vector: np.ndarray) -> Weights:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = np.asarray(vector[at:at + n], dtype=np.float32).reshape(shape).copy()
        at += n
    return out


def flatten(w: Weights) -> np.ndarray:
    return np.concatenate([w[name].ravel() for name in _SHAPES])


def initial(seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    w = {name: np.zeros(shape, np.float32) for name, shape in _SHAPES.items()}
    w["embed"] = rng.normal(0, 0.3, _SHAPES["embed"]).astype(np.float32)
    w["place"] = (1 + rng.normal(0, 0.1, _SHAPES["place"])).astype(np.float32)
    for name in ("group", "member"):
        w[name] = rng.normal(0, 0.1, _SHAPES[name]).astype(np.float32)
    return flatten(w)


def tokens(t: textbytes.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, their contexts, first token of each text) of a slice of texts."""
    w = textbytes.words(t)
    token = (textbytes.Spans(t.buf, fold=True).hash(w.start, w.end) >> np.uint64(20)).astype(np.int64) % VOCABULARY
    owner = w.owner
    wide = np.concatenate([[_EDGE] * 2, token, [_EDGE] * 2])
    own = np.concatenate([[-1] * 2, owner, [-1] * 2])
    n = len(token)
    context = np.stack([np.where(own[2 + p:2 + p + n] == owner, wide[2 + p:2 + p + n], _EDGE) for p in PLACES], axis=1)
    return token, context, w.first


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _hidden(w: Weights, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    around = w["embed"][context]
    return around, np.tanh((around * w["place"]).sum(axis=1) + w["shift"])


def log_probabilities(w: Weights, token: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Log probability of each token given its context."""
    out = np.empty(len(token))
    for i in range(0, len(token), 8 * BATCH):
        part = slice(i, i + 8 * BATCH)
        group, member = np.divmod(token[part], GROUPS)
        _, h = _hidden(w, context[part])
        row = np.arange(len(group))
        out[part] = (_log_softmax(h @ w["group"] + w["group_shift"])[row, group]
                     + _log_softmax(h @ w["member"] + w["member_shift"][group])[row, member])
    return out


def descend(w: Weights, past: Weights, token: np.ndarray, context: np.ndarray) -> None:
    """One Adagrad step on a batch, in place; ``past`` holds the squared gradients so far."""
    n = len(token)
    group, member = np.divmod(token, GROUPS)
    around, h = _hidden(w, context)
    row = np.arange(n)
    d1 = np.exp(_log_softmax(h @ w["group"] + w["group_shift"]))
    d2 = np.exp(_log_softmax(h @ w["member"] + w["member_shift"][group]))
    d1[row, group] -= 1
    d2[row, member] -= 1
    d1 /= n
    d2 /= n
    one = np.zeros((n, GROUPS), np.float32)
    one[row, group] = 1
    back = (d1 @ w["group"].T + d2 @ w["member"].T) * (1 - h * h)
    to_embed = back[:, None, :] * w["place"]
    at = (context[:, :, None] * WIDTH + np.arange(WIDTH)).ravel()
    gradient = {
        "embed": np.bincount(at, to_embed.ravel(), minlength=(VOCABULARY + 1) * WIDTH).reshape(_SHAPES["embed"]),
        "place": np.einsum("nw,npw->pw", back, around), "shift": back.sum(axis=0),
        "group": h.T @ d1, "group_shift": d1.sum(axis=0), "member": h.T @ d2, "member_shift": one.T @ d2,
    }
    for name, g in gradient.items():
        past[name] += g * g
        w[name] -= (RATE * g / np.sqrt(past[name])).astype(np.float32)


def _round(place: np.ndarray, rounds: int) -> np.ndarray:
    """The round in which the token at each place is a target."""
    turn = (place // rounds).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    return (place + turn.astype(np.int64)) % rounds


def _trained(start: np.ndarray, number: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = unflatten(start)
        past = {name: np.full(shape, 1e-6) for name, shape in _SHAPES.items()}
        seen = 0
        for batch in batches:
            for t in textbytes.slices(batch.column(0)):
                token, context, first = tokens(t)
                place = np.arange(len(token)) - np.repeat(first[:-1], np.diff(first))
                masked = np.flatnonzero(_round(place, rounds) == number)
                for i in range(0, len(masked), BATCH):
                    descend(w, past, token[masked[i:i + BATCH]], context[masked[i:i + BATCH]])
                seen += len(masked)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([flatten(w)], pa.list_(pa.float32()))],
                                             names=["seen", "weights"])
    return run


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """The network's weights after ``rounds`` of local descent and averaging over all documents."""
    vector = initial(seed)
    read = docs.select(F.col(text).cast("string"))
    for number in range(rounds):
        sent = read.mapInArrow(_trained(vector, number, rounds), "seen long, weights array<float>")
        mean = (sent.select("seen", F.posexplode("weights").alias("at", "weight")).groupBy("at")
                .agg((F.sum(F.col("seen") * F.col("weight").cast("double")) / F.sum("seen")).alias("weight")).toArrow())
        if len(mean):
            vector = np.zeros(PARAMETERS)
            vector[mean["at"].to_numpy()] = mean["weight"].to_numpy()
    return vector.astype(np.float32)


def _score(vector: np.ndarray, text: Column) -> Column:
    @F.arrow_udf("n_tokens long, log_likelihood double")
    def run(column: pa.Array) -> pa.Array:
        w = unflatten(vector)
        count, total = [np.zeros(0, np.int64)], [np.zeros(0)]
        for t in textbytes.slices(column):
            token, context, first = tokens(t)
            running = np.concatenate([[0.0], np.cumsum(log_probabilities(w, token, context))])
            count.append(np.diff(first))
            total.append(running[first[1:]] - running[first[:-1]])
        return pa.StructArray.from_arrays([pa.array(np.concatenate(count)), pa.array(np.concatenate(total))],
                                          names=["n_tokens", "log_likelihood"])
    return run(text.cast("string"))


def score(docs: DataFrame, vector: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: (key, n_tokens, log_likelihood, mean_log_likelihood, perplexity)."""
    mean = F.when(F.col("s.n_tokens") > 0, F.col("s.log_likelihood") / F.col("s.n_tokens"))
    return (docs.select(F.col(key), _score(vector, F.col(text)).alias("s"))
            .select(key, "s.n_tokens", "s.log_likelihood", mean.alias("mean_log_likelihood"), F.exp(-mean).alias("perplexity")))
