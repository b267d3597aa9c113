"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads a window of bytes in both directions (two GRUs of ``HIDDEN``
units), gives every position a probability for each learned language, and a
text the mean over all positions of letters. A text is read whole, in windows of
``WINDOW`` bytes side by side; A-Z are read as a-z. It is trained here, in numpy, by
backpropagation through time with Adam, on windows of ``TRAIN_WINDOW`` bytes.

Training rows: per language about ``TRAIN_DOCS`` documents, those with the smallest
hash of their id, ``TRAIN_CUTS`` windows of each at hashed places (documented
bounds of the fit); every language that the rows have is learned. Prediction reads all bytes of all texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as
is every text if nothing could be learned; a null id counts as the empty string in the
split; rows with null lang are not learned from; a repeated row gives a
repeated result row; an empty table an empty result; other columns pass by
unread (``keep_identified`` keeps the columns it is given).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import narrow, table, text_or_empty

HIDDEN = 8
WINDOW = 128
LANES = 2048
TRAIN_WINDOW = 64
TRAIN_DOCS = 400
TRAIN_CUTS = 6
TRAIN_STEPS = 400
TRAIN_BATCH = 256
#: A text whose best language has a lower mean probability is rejected by the filter.
MIN_SCORE = 0.35

FOLD = np.arange(256)
FOLD[65:91] += 32
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Network:
    """``inputs``: per direction the byte table (3H x 256); ``states``: (3H x H); gates
    in the order update, reset, candidate; ``out`` (L x 2H) and ``bias`` (L)."""
    langs: list[str]
    inputs: list[np.ndarray]
    states: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, self.out, self.bias]


def new_network(langs: list[str], hidden: int = HIDDEN, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    make = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
    return Network(langs, [make(3 * hidden, 256, s=0.5) for _ in range(2)],
                   [make(3 * hidden, hidden, s=hidden ** -0.5) for _ in range(2)],
                   make(len(langs), 2 * hidden, s=0.3), np.zeros(len(langs), np.float32))


def gru(table_: np.ndarray, state: np.ndarray, data: np.ndarray, order: range, keep: list | None = None) -> np.ndarray:
    """States (positions x H x lanes) of one direction over ``data`` (positions x lanes).
    ``keep`` gets (z, r, n, u, h) of each step for the way back."""
    hidden, lanes = state.shape[1], data.shape[1]
    out = np.empty((data.shape[0], hidden, lanes), np.float32)
    h = np.zeros((hidden, lanes), np.float32)
    x = np.empty((3 * hidden, lanes), np.float32)
    g = np.empty((3 * hidden, lanes), np.float32)
    for t in order:
        np.take(table_, data[t], axis=1, out=x, mode="clip")
        np.matmul(state, h, out=g)
        gates = x[:2 * hidden]
        gates += g[:2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r, u = gates[:hidden], gates[hidden:], g[2 * hidden:]
        n = np.multiply(r, u, out=out[t])
        n += x[2 * hidden:]
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((z.copy(), r.copy(), n.copy(), u.copy(), h))
        h = h - n
        h *= z
        n += h  # n + z (h - n)
        h = n
    return out


def position_probabilities(net: Network, data: np.ndarray) -> np.ndarray:
    """(L x positions x lanes) for ``data`` (positions x lanes) of bytes."""
    n, lanes = data.shape
    f = gru(net.inputs[0], net.states[0], data, range(n))
    b = gru(net.inputs[1], net.states[1], data, range(n - 1, -1, -1))
    hidden = f.shape[1]
    logits = np.matmul(net.out[:, :hidden], f) + np.matmul(net.out[:, hidden:], b) + net.bias[:, None]  # n x L x lanes
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits, out=logits)
    p /= p.sum(axis=1, keepdims=True)
    return p.transpose(1, 0, 2)


def gradients(net: Network, data: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the masked positions and its gradients, by backpropagation through time."""
    n, lanes = data.shape
    orders = (range(n), range(n - 1, -1, -1))
    keeps: list[list] = [[], []]
    hs = [gru(net.inputs[d], net.states[d], data, orders[d], keeps[d]) for d in range(2)]
    hidden = hs[0].shape[1]
    h = np.concatenate(hs, axis=1)
    logits = np.matmul(net.out, h) + net.bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    weight = mask / max(1, mask.sum())
    lane = np.arange(lanes)
    loss = -float((np.log(p[:, y, lane] + 1e-9) * weight).sum())
    p[:, y, lane] -= 1
    p *= weight[:, None, :]
    g_out = np.einsum("tlb,tkb->lk", p, h, optimize=True).astype(np.float32)
    g_bias = p.sum(axis=(0, 2)).astype(np.float32)
    g_h = np.matmul(net.out.T, p)
    g_inputs, g_states = [], []
    for d in range(2):
        g_state = np.zeros_like(net.states[d])
        g_x = np.empty((n, 3 * hidden, lanes), np.float32)
        carry = np.zeros((hidden, lanes), np.float32)
        for t, (z, r, c, u, before) in zip(reversed(orders[d]), reversed(keeps[d]), strict=True):
            gh = g_h[t, d * hidden:(d + 1) * hidden] + carry
            g_c = gh * (1 - z) * (1 - c * c)
            g_z = gh * (before - c) * z * (1 - z)
            g_r = g_c * u * r * (1 - r)
            g_gates = np.concatenate([g_z, g_r, g_c * r])
            g_state += g_gates @ before.T
            carry = gh * z + net.states[d].T @ g_gates
            g_x[t, :2 * hidden], g_x[t, 2 * hidden:] = g_gates[:2 * hidden], g_c
        flat = data.ravel()
        by_row = g_x.transpose(1, 0, 2).reshape(3 * hidden, -1)
        g_inputs.append(np.stack([np.bincount(flat, row, 256) for row in by_row]).astype(np.float32))
        g_states.append(g_state)
    return loss, [*g_inputs, *g_states, g_out, g_bias]


def windows(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (windows x size, padded by 0), the letters among them, and each window's text."""
    raw = [t.encode() for t in texts]
    counts = np.array([max(1, -(-len(b) // size)) for b in raw], np.int64)
    data = np.frombuffer(b"".join(b.ljust(int(k) * size, b"\0") for b, k in zip(raw, counts, strict=True)), np.uint8)
    data = data.reshape(-1, size)
    return FOLD[data], LETTER[data], np.repeat(np.arange(len(raw)), counts)


def train_network(texts: list[str], langs: list[str], hidden: int = HIDDEN, steps: int = TRAIN_STEPS,
                  seed: int = 0) -> Network:
    names = sorted(set(langs))
    data, letters, owner = windows(texts, TRAIN_WINDOW)
    number = {x: i for i, x in enumerate(names)}
    y = np.array([number[x] for x in langs])[owner]
    use = np.flatnonzero(letters.sum(axis=1) >= 8)
    net = new_network(names, hidden, seed)
    if len(names) < 2 or not len(use):
        return net
    rng = np.random.default_rng(seed + 1)
    by_lang = [use[y[use] == k] for k in range(len(names))]
    by_lang = [x for x in by_lang if len(x)]
    m = [np.zeros_like(p) for p in net.params()]
    v = [np.zeros_like(p) for p in net.params()]
    for step in range(1, steps + 1):
        each = -(-TRAIN_BATCH // len(by_lang))  # the languages have equal shares of a batch
        pick = np.concatenate([rng.choice(x, each) for x in by_lang])
        _, grads = gradients(net, np.ascontiguousarray(data[pick].T), letters[pick].T.astype(np.float32), y[pick])
        norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grads))))
        rate = 0.02 * min(1.0, 2.0 * (1 - (step - 1) / steps))
        for p, g, a, b in zip(net.params(), grads, m, v, strict=True):
            g = g / norm
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
    return net


def document_probabilities(net: Network, texts: list[str]) -> np.ndarray:
    """Mean position probabilities over the letters (texts x L); rows without letters are 0."""
    out = np.zeros((len(texts), len(net.langs)))
    letters_of = np.zeros(len(texts))
    step = 256
    for k in range(0, len(texts), step):
        data, letters, owner = windows(texts[k:k + step], WINDOW)
        for i in range(0, len(data), LANES):
            part = np.ascontiguousarray(data[i:i + LANES].T)
            mask = letters[i:i + LANES].T
            p = position_probabilities(net, part)
            who = owner[i:i + LANES] + k
            for lang in range(len(net.langs)):
                out[:, lang] += np.bincount(who, (p[lang] * mask).sum(axis=0), len(texts))
            letters_of += np.bincount(who, mask.sum(axis=0), len(texts))
    return out / np.maximum(letters_of, 1)[:, None]


def remainder(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network learned from the rows that are not held out; None if there is no language to learn."""
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("content"), F.col(lang_col).alias("y"),
                        remainder(id_col).alias("part"))
            .filter((F.col("part") != 2) & F.col("y").isNotNull() & F.col("content").rlike(r"\p{L}")))
    sizes = rows.groupBy("y").count()
    n = sizes.count()
    if not n:
        return None
    # a hash's place among its language's rows is about its share of the range times their count
    unit = F.shiftrightunsigned(F.xxhash64("id", F.lit(7)), 11).cast("double") / float(1 << 53)
    sample = (rows.join(narrow(sizes, n), "y").withColumn("place", unit * F.col("count"))
              .filter(F.col("place") <= 2 * TRAIN_DOCS).select("y", "content", "place", "id")
              .orderBy("place", "id").limit(n * TRAIN_DOCS))
    room = F.greatest(F.length("content") - TRAIN_WINDOW, F.lit(1))
    cut = [F.substr("content", (F.pmod(F.xxhash64("id", F.lit(j)), room) + 1).cast("int"), F.lit(TRAIN_WINDOW))
           for j in range(TRAIN_CUTS)]
    got = sample.select("y", F.explode(F.array(*cut)).alias("cut")).toPandas()
    return train_network([t.encode()[:TRAIN_WINDOW].decode("utf-8", "ignore") for t in got["cut"]], got["y"].tolist())


def predict(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, all columns kept."""
    def label(texts: pd.Series) -> pd.DataFrame:
        found = texts.tolist()
        if net is None:
            return pd.DataFrame({"lang": ["und"] * len(found), "score": 0.0})
        p = document_probabilities(net, found)
        best = p.argmax(axis=1) if len(found) else np.zeros(0, int)
        lettered = np.array([any(map(str.isalpha, t)) for t in found], bool)
        return pd.DataFrame({"lang": np.where(lettered, np.array(net.langs, object)[best], "und"),
                             "score": np.where(lettered, np.clip(p.max(axis=1), 0, 1), 0.0)})

    labelled = docs.withColumn("__l", F.pandas_udf(label, "lang string, score double")(text_or_empty(text_col)))
    return labelled.withColumns({"lang_pred": F.col("__l.lang"), "score": F.col("__l.score")}).drop("__l")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = docs.select("doc_id", (remainder() == 2).alias("held_out"), "text")
    return predict(held, train(docs)).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without texts that have no letters or no language of a mean probability of ``MIN_SCORE``."""
    net = train(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    return predict(rows, net).filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select("row.*")
