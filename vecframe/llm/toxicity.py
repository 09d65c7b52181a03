"""Toxicity of documents by a bidirectional gated recurrent network with attention over windows of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import modest_batches, small_side, stored, text_buffers, text_chunks
from vecframe.llm.shingles import shingle, span_hashes, word_spans

WINDOW = 32
STRIDE = 16
#: Labelled rows of each class, by hash of their key, that the network is trained on at most.
TRAIN_ROWS = 1200
BITS = 18
#: Lengths of character grams, a word's bounds included.
GRAMS = (4, 7)
EMBED = 8
WIDTH = EMBED * (1 + len(GRAMS))
HIDDEN = 8
STEPS = 120
ROUNDS = 3
BATCH = 144
RATE = 0.01
#: Chance that a part of a word's input (the word, its shorter or its longer grams) is seen in training.
KEEP = 0.8
DECAY = 0.0005
SEED = 3
#: Words and grams that fewer training texts have are unknown, so that no text can be learned by heart from them.
LEAST_TEXTS = 5
#: Texts whose words and grams are counted at a time.
TEXTS_COUNTED = 100
#: Words whose grams are summed at a time.
WORDS_SUMMED = 16_384
#: Words are runs of letters and digits, taken bytewise; bytes from 0x80 on belong to letters.
EMBEDDED = ("word", "gram")
OTHER = np.ones(256, bool)
OTHER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Words:
    """The words of some texts: hashes, places, and the window starts of every text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data = data
        self.starts, self.ends, text = word_spans(data, bounds, OTHER)
        self.hashes = span_hashes(data, self.starts, self.ends)
        self.counts = np.bincount(text, minlength=len(bounds) - 1)
        firsts = np.cumsum(self.counts) - self.counts
        self.windows = np.maximum(-(-(self.counts - WINDOW) // STRIDE) + 1, 1)
        place = (np.arange(self.windows.sum()) - np.repeat(np.cumsum(self.windows) - self.windows, self.windows)) * STRIDE
        self.begin = np.repeat(firsts, self.windows) + place
        self.length = np.minimum(np.repeat(self.counts, self.windows) - place, WINDOW)

    def distinct(self, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Of the words ``used``: number of each in the list of distinct ones, and of these the word bucket and, for each
        length of grams, the buckets and counts of their character grams."""
        picked = np.arange(len(self.hashes)) if used is None else used
        hashes, first, inverse = np.unique(self.hashes[picked], return_index=True, return_inverse=True)
        starts, sizes = self.starts[picked[first]], (self.ends - self.starts)[picked[first]]
        marked = np.cumsum(sizes + 2) - sizes - 2
        letters = np.zeros(int((sizes + 2).sum()), np.uint64)
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        letters[np.repeat(marked + 1, sizes) + within] = self.data[np.repeat(starts, sizes) + within]
        letters[marked], letters[marked + sizes + 1] = 300, 301  # the word's bounds
        grams = [shingle(letters, sizes + 2, n) for n in GRAMS]
        return inverse, _bucket(hashes), [(_bucket(found + np.uint64(n)), counts) for n, (found, counts) in zip(GRAMS, grams, strict=True)]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Word and character-gram embeddings, one gated recurrent layer each way, attention pooling, one logit."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": draw(1 << BITS, EMBED, scale=0.1), "gram": draw(1 << BITS, EMBED, scale=0.1), "query": draw(2 * HIDDEN, scale=0.3), "out": draw(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": draw(WIDTH, 3 * HIDDEN, scale=0.4), f"h{d}": draw(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, words: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]], keep: np.ndarray | None = None) -> np.ndarray:
        """One input row per distinct word, and a row of zeros for places after a window's end."""
        x = np.zeros((len(words) + 1, WIDTH), np.float32)
        if len(words):
            x[:-1, :EMBED] = self.p["word"][words]
            for i, (buckets, counts) in enumerate(grams, 1):
                ends = np.cumsum(counts)
                for at in range(0, len(words), WORDS_SUMMED):
                    part = slice(at, at + WORDS_SUMMED)
                    first = ends[at] - counts[at]
                    sums = np.add.reduceat(self.p["gram"][buckets[first : ends[part][-1]]], ends[part] - counts[part] - first, axis=0)
                    x[part.start : at + len(sums), i * EMBED : (i + 1) * EMBED] = sums / np.sqrt(counts[part])[:, None]
            if keep is not None:
                x[:-1] *= keep
        return x

    def forward(self, x: np.ndarray, at: np.ndarray, there: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logits of windows: ``at`` are rows of ``x`` of shape (steps, windows), ``there`` marks words."""
        steps, n = at.shape
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        for side, d in enumerate("fb"):
            gates_x = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
            u, h = self.p[f"h{d}"], np.zeros((n, HIDDEN), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                gx, gh = gates_x[at[t]], h @ u
                zr = _sigmoid(gx[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(gx[:, 2 * HIDDEN :] + r * gh[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                if not there[t].all():
                    new = np.where(there[t][:, None], new, h)
                if tape is not None:
                    tape[d, t] = (h, z, r, c, gh[:, 2 * HIDDEN :])
                h = new
                states[t, :, side * HIDDEN : (side + 1) * HIDDEN] = h
        weight = np.where(there, states @ self.p["query"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0)) * there
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (states * weight[:, :, None]).sum(axis=0)
        if tape is not None:
            tape |= {"states": states, "weight": weight, "pooled": pooled, "x": x}
        return pooled @ self.p["out"] + self.p["bias"][0]

    def backward(self, tape: dict, at: np.ndarray, there: np.ndarray, grad: np.ndarray, words, grams, keep) -> dict:
        """Gradients by name; those of the embeddings are (rows, gradients of these rows)."""
        g = {k: np.zeros_like(v) for k, v in self.p.items() if k not in EMBEDDED}
        states, weight, pooled, x = (tape[k] for k in ("states", "weight", "pooled", "x"))
        g["out"], g["bias"][0] = pooled.T @ grad, grad.sum()
        dpool = grad[:, None] * self.p["out"]
        dscore = weight * ((states * dpool).sum(axis=2) - (pooled * dpool).sum(axis=1))
        g["query"] = np.einsum("tn,tnh->h", dscore, states)
        dstates = weight[:, :, None] * dpool + dscore[:, :, None] * self.p["query"]
        dx = np.zeros_like(x)
        for side, d in enumerate("fb"):
            u, dh = self.p[f"h{d}"], np.zeros((at.shape[1], HIDDEN), np.float32)
            dgates = np.zeros((len(x), 3 * HIDDEN), np.float32)
            for t in range(len(at) - 1, -1, -1) if d == "f" else range(len(at)):
                h, z, r, c, ghc = tape[d, t]
                dh = dh + dstates[t, :, side * HIDDEN : (side + 1) * HIDDEN]
                live = there[t][:, None]
                dn = np.where(live, dh, 0)
                dc = dn * (1 - z) * (1 - c * c)
                dz, dr = dn * (h - c) * z * (1 - z), dc * ghc * r * (1 - r)
                dgh = np.concatenate((dz, dr, dc * r), axis=1)
                g[f"h{d}"] += h.T @ dgh
                np.add.at(dgates, at[t], np.concatenate((dz, dr, dc), axis=1))
                dh = np.where(live, dn * z, dh) + dgh @ u.T
            dgates[-1] = 0
            g[f"c{d}"] = dgates.sum(axis=0)
            g[f"x{d}"] = x.T @ dgates
            dx += dgates @ self.p[f"x{d}"].T
        dx = dx[:-1] * keep
        g["word"] = _rows_summed(words, dx[:, :EMBED])
        parts = [np.repeat(dx[:, i * EMBED : (i + 1) * EMBED] / np.sqrt(counts)[:, None], counts, axis=0) for i, (_, counts) in enumerate(grams, 1)]
        g["gram"] = _rows_summed(np.concatenate([buckets for buckets, _ in grams]), np.concatenate(parts))
        return g

    def window_logits(self, words: Words, picked: np.ndarray | None = None, most: int = 4096) -> np.ndarray:
        """Logits of all windows of the texts, or of those picked."""
        inverse, word, grams = words.distinct()
        x, inverse = self.inputs(word, grams), np.append(inverse, len(word))
        picked = np.arange(len(words.begin)) if picked is None else picked
        out = np.zeros(len(picked), np.float32)
        for i in range(0, len(picked), most):
            at, there = _places(words, picked[i : i + most])
            out[i : i + most] = self.forward(x, inverse[np.where(there, at, len(inverse) - 1)], there)
        return out

    def scores(self, words: Words) -> np.ndarray:
        """Chance that a text is toxic, from its highest window."""
        best = np.maximum.reduceat(self.window_logits(words), np.cumsum(words.windows) - words.windows) if len(words.windows) else np.zeros(0)
        return _sigmoid(self.scale * best.astype(np.float64) + self.shift)


def _rows_summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    found, first = np.unique(rows[order], return_index=True)
    return found, np.add.reduceat(values[order], first, axis=0) if len(found) else values[:0]


def _places(words: Words, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of shape (steps, windows) and which of them there are."""
    step = np.arange(max(1, int(words.length[picked].max(initial=0))))[:, None]
    return words.begin[picked] + step, step < words.length[picked]


def train(texts: list[str], toxic: np.ndarray, odds: float, seed: int = SEED) -> Network:
    """A network from labelled texts, of which only the windows that look toxic count as toxic.

    The windows of a toxic text that are taken as toxic are first chosen by how much more often their character grams occur in
    toxic texts, then by the network itself, again each round; harmless texts give random windows
    and those that look worst. At last the highest window of each text is turned into a chance by logistic
    regression, with the classes weighed to have the given odds.
    """
    net, rng = Network(seed), np.random.default_rng(seed)
    words = Words(*text_buffers(pa.array(texts, pa.string())))
    owner = np.repeat(np.arange(len(texts)), words.windows)
    first = np.cumsum(words.windows) - words.windows
    # The first number of an embedding starts as the log-odds of the texts that have the word or gram.
    known, told, odds_of = _telling_windows(words, toxic, owner, first)
    for k in EMBEDDED:
        net.p[k][~known[k]] = 0
        net.p[k][:, 0] += 0.5 * odds_of[k]
    best = told
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    # A fifth of the texts is kept for turning logits into chances, if there are enough.
    judge = np.zeros(len(texts), bool)
    for side in (toxic, ~toxic):
        own = rng.permutation(np.flatnonzero(side))
        judge[own[: len(own) // 5]] = True
    yes, no = np.flatnonzero(toxic & ~judge), np.flatnonzero(~toxic & ~judge)
    if (toxic & judge).sum() < 5:
        judge[:] = True
    step = 0
    for _ in range(ROUNDS):
        for _ in range(STEPS):
            step += 1
            a, b, c = rng.choice(yes, BATCH // 3), rng.choice(no, BATCH // 3), rng.choice(no, BATCH // 3)
            picked = np.concatenate((best[a], best[b], first[c] + (rng.random(len(c)) * words.windows[c]).astype(np.int64)))
            target = np.repeat([1.0, 0.0], [len(a), len(b) + len(c)]).astype(np.float32)
            at, there = _places(words, picked)
            used, number = np.unique(at[there], return_inverse=True)
            inverse, word, grams = words.distinct(used)
            local = np.full(at.shape, len(word))
            local[there] = inverse[number]
            # Words are often seen without one of their three parts, so that no part is needed.
            keep = np.repeat((rng.random((len(word), 1 + len(GRAMS))) < KEEP).astype(np.float32), EMBED, axis=1)
            tape: dict = {}
            logits = net.forward(net.inputs(word, grams, keep), local, there, tape)
            grads = net.backward(tape, local, there, ((_sigmoid(logits) - target) / len(target)).astype(np.float32), word, grams, keep)
            for k, g in grads.items():
                rows = slice(None)
                if k in EMBEDDED:
                    learned = known[k][g[0]]
                    rows, g = g[0][learned], g[1][learned]
                m, v = (moment[rows] for moment in moments[k])
                m, v = m + 0.1 * (g - m), v + 0.01 * (g * g - v)
                moments[k][0][rows], moments[k][1][rows] = m, v
                net.p[k][rows] -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) + DECAY * net.p[k][rows]).astype(np.float32)
        logits = net.window_logits(words)
        best = np.lexsort((logits, owner))[first + words.windows - 1]
        # A toxic text of which nothing looks toxic yet keeps the window its grams told of.
        highest = best
        best = np.where(toxic & (logits[best] < 0), told, best)
    net.scale, net.shift = _logistic(logits[highest][judge].astype(np.float64), toxic[judge], odds)
    return net


def _telling_windows(words: Words, toxic: np.ndarray, owner: np.ndarray, first: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, dict[str, np.ndarray]]:
    """Which word and gram buckets enough texts have; for each text the window with the highest sum of its words' most
    telling log-odds, their own or of a gram; and these log-odds by bucket."""
    inverse, word, grams = words.distinct()
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    with_it = {k: np.zeros((2, 1 << BITS), np.int64) for k in EMBEDDED}
    for at in range(0, len(words.counts), TEXTS_COUNTED):
        low, high = np.searchsorted(text, [at, at + TEXTS_COUNTED])
        # The distinct words of each text.
        own, word_no = np.divmod(np.unique(text[low:high] * len(word) + inverse[low:high]), max(1, len(word)))
        having = {
            "word": np.unique(own << BITS | word[word_no]),
            "gram": np.unique(np.concatenate([np.repeat(own, counts[word_no]) << BITS | _grams_of(buckets, counts, word_no) for buckets, counts in grams])),
        }
        for k, pairs in having.items():
            for side in (0, 1):
                with_it[k][side] += np.bincount((pairs & ((1 << BITS) - 1))[toxic[pairs >> BITS] == side], minlength=1 << BITS)
    known, odds = {}, {}
    for k, (harmless, bad) in with_it.items():
        known[k] = harmless + bad >= LEAST_TEXTS
        ratio = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((harmless + 0.5) / ((~toxic).sum() + 1))
        odds[k] = np.where(known[k], np.clip(ratio, -2, 6), 0).astype(np.float32)
    value = np.zeros(1)
    if len(word):
        telling = np.max([odds["word"][word], *(np.maximum.reduceat(odds["gram"][buckets], np.cumsum(counts) - counts) for buckets, counts in grams)], axis=0)
        value = np.append(0, np.cumsum(np.maximum(telling - 1, 0)[inverse]))
    sums = value[words.begin + words.length] - value[words.begin]
    return known, np.lexsort((sums, owner))[first + words.windows - 1], odds


def _grams_of(gram: np.ndarray, counts: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    sizes = counts[inverse]
    begin = (np.cumsum(counts) - counts)[inverse]
    return gram[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)]


def _logistic(x: np.ndarray, y: np.ndarray, odds: float) -> tuple[float, float]:
    """Scale and shift of a weighed logistic regression of y on x, by Newton's method in short steps; scale is drawn to 1 and shift to 0."""
    weight = np.where(y, odds / max(y.sum(), 1), 1 / max((~y).sum(), 1)) * len(y) / (1 + odds)
    design, w = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ w)
        grad = design.T @ (weight * (p - y)) + w - [1.0, 0.0]
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step / max(1.0, np.abs(step).max())
    return float(max(w[0], 1e-3)), float(w[1])


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> Network:
    """A network trained on at most ``rows`` labelled documents of each class, never on held-out ones."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(key).agg(F.max(label).alias("toxic"))
    known = stored(known.select(F.col(key).alias("of"), (F.col("toxic") == 1).alias("toxic")), "toxicity-labels")
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = [known.where(F.col("toxic") == side).orderBy(F.xxhash64("of"), "of").limit(rows) for side in (True, False)]
    sample = stored(picked[0].unionByName(picked[1]), "toxicity-sample")
    texts = docs.select(F.col(key).alias("id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text")).join(small_side(sample, 16), F.col("id") == F.col("of")).select("id", "text", "toxic")
    # Rows of a key are kept to one, so that a key with many copies cannot fill the driver.
    held = texts.groupBy("id", "toxic").agg(F.min("text").alias("text")).orderBy("id").toArrow()
    toxic = np.array(held["toxic"].to_pylist(), bool)
    if not toxic.any() or toxic.all():
        net = Network()
        net.scale, net.shift = 0.0, 8.0 if toxic.any() else -8.0
        return net
    return train(held["text"].to_pylist(), toxic, sizes[True] / sizes[False])


def score(docs: DataFrame, net: Network, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, held_out, score, predicted) per document."""
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col(key).alias("id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    schema = rows.select("id", F.lit(0.0).cast("double").alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.scores(Words(data, bounds)) for _, data, bounds in text_chunks(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.concatenate([*scores, np.zeros(0)]), pa.float64())], names=["id", "score"])

    return rows.mapInArrow(run, schema).select(F.col("id").alias(key), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """One row (key, held_out, score, predicted) per document; the network is trained first.

    Rows whose crc32 of the key as text is 0 mod 5 are held out: they are scored but never trained on. A text is cut into
    windows of ``WINDOW`` words every ``STRIDE`` words, all of them are scored, and the highest decides. The
    text in lower case is the only input.

    A null text is empty; a text without words has one window without words. A document with a null key is scored and not
    held out. Of several labels of a key the highest holds, of several texts of a labelled key the first by code point is
    trained on. Without labels of both classes every score is the same: near 0, or near 1 if all are toxic.
    An empty table gives no rows. Other columns are not read.
    """
    return score(docs, fit(docs, labels, key=key, text=text, label=label, rows=rows), key=key, text=text)
