"""Language of texts by a bidirectional gated recurrent network over their bytes."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from plumbline.llm.arrow import append_columns, column, free_of, packed, unpacked
from plumbline.llm.joins import spread_join
from plumbline.llm.words import utf8
from plumbline.session import scratch, written_table

UNKNOWN = "und"
UNITS = 8
#: Bytes that are labelled in one window, and those before and after it that only lead in.
CORE, LEAD = 240, 16
#: Windows that run through the network at once.
WINDOWS = 1024
#: The bound of the training sample: rows of each language, and pieces of each row.
ROWS_PER_LANGUAGE, PIECES, PIECE_CHARS = 400, 3, 96
#: Rows of all languages together, but for one of each.
MOST_ROWS = 100_000


class ByteNetwork:
    """Two gated recurrent layers, one in each direction, and a softmax at each byte.

    A unit's gate z and candidate c come from the byte and the state before it,
    h' = h + z (c - h). The gate is (1 + tanh) / 2, so one tanh serves both.
    """

    def __init__(self, languages, units=UNITS, seed=0):
        rng = np.random.default_rng(seed)
        n = len(languages)
        self.languages, self.units = list(languages), units
        self.weights = {"bias": np.zeros(n, np.float32)}
        for side in "fb":
            self.weights[f"byte_{side}"] = rng.normal(0, 0.3, (256, 2 * units)).astype(np.float32)
            self.weights[f"state_{side}"] = rng.normal(0, 0.3, (units, 2 * units)).astype(np.float32)
            self.weights[f"out_{side}"] = rng.normal(0, 0.3, (units, n)).astype(np.float32)

    def probabilities(self, windows, sizes):
        """At each byte of windows ordered by falling size: [byte, language, window]."""
        n, steps = windows.shape
        u, w = self.units, self.weights
        turned = np.ascontiguousarray(windows.T)
        active = [int(np.searchsorted(-sizes, -t, "left")) for t in range(steps)]
        logits = np.empty((steps, len(self.languages), n), np.float32)
        logits[:] = w["bias"][None, :, None]
        for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            bytes_in = np.ascontiguousarray(w[f"byte_{side}"].T)
            state_in = np.ascontiguousarray(w[f"state_{side}"].T)
            out = np.ascontiguousarray(w[f"out_{side}"].T)
            h = np.zeros((u, n), np.float32)
            for t in order:
                k = active[t]
                if not k:
                    continue
                g = np.take(bytes_in, turned[t, :k], axis=1)
                g += state_in @ h[:, :k]
                np.tanh(g, out=g)
                gate, change = g[:u], g[u:]
                gate += 1
                gate *= 0.5
                change -= h[:, :k]
                change *= gate
                h[:, :k] += change
                logits[t, :, :k] += out @ h[:, :k]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, windows, sizes, labels):
        """The gradient of the mean cross-entropy of all bytes, back through time."""
        n, steps = windows.shape
        u, w = self.units, self.weights
        mask = (np.arange(steps)[:, None] < sizes[None, :]).astype(np.float32)
        logits = np.zeros((steps, n, len(self.languages)), np.float32) + w["bias"]
        kept = {}
        for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            h = np.zeros((n, u), np.float32)
            trace = [None] * steps
            for t in order:
                g = np.tanh(w[f"byte_{side}"][windows[:, t]] + h @ w[f"state_{side}"])
                gate, change = (g[:, :u] + 1) / 2, g[:, u:]
                after = (h + gate * (change - h)) * mask[t][:, None]
                trace[t] = (h, g, after)
                logits[t] += after @ w[f"out_{side}"]
                h = after
            kept[side] = trace
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(n), labels] -= 1
        p *= (mask / mask.sum())[:, :, None]
        found = {"bias": p.sum(axis=(0, 1))}
        for side, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
            out, state = w[f"out_{side}"], w[f"state_{side}"]
            d_out, d_state = np.zeros_like(out), np.zeros_like(state)
            d_in = np.zeros((steps, n, 2 * u), np.float32)
            dh = np.zeros((n, u), np.float32)
            for t in order:
                h, g, after = kept[side][t]
                d_out += after.T @ p[t]
                dh = (dh + p[t] @ out.T) * mask[t][:, None]
                gate, change = (g[:, :u] + 1) / 2, g[:, u:]
                d = d_in[t]
                d[:, :u] = dh * (change - h) * 0.5 * (1 - g[:, :u] ** 2)
                d[:, u:] = dh * gate * (1 - change**2)
                d_state += h.T @ d
                dh = dh * (1 - gate) + d @ state.T
            flat, d_in = windows.T.ravel(), d_in.reshape(-1, 2 * u)
            d_byte = np.stack([np.bincount(flat, d_in[:, k], 256) for k in range(2 * u)], axis=1)
            found |= {f"out_{side}": d_out, f"state_{side}": d_state, f"byte_{side}": d_byte.astype(np.float32)}
        return found

    def train(self, windows, sizes, labels, steps=240, batch=192, rate=0.02, seed=0):
        """Adam over batches in a fixed random order."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(windows), batch)
            pace = rate * min(1.0, 2 * (1 - (step - 1) / steps))
            for k, g in self.gradients(windows[rows], sizes[rows], labels[rows]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                fair = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - pace * fair).astype(np.float32)
        return self

    def score(self, data, bounds):
        """Mean probability of each language over all bytes of each text."""
        pooled = np.zeros((len(bounds) - 1, len(self.languages)))
        texts = np.diff(bounds)
        pieces = -(-texts // CORE)
        of = np.repeat(np.arange(len(texts)), pieces)
        at = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        core = at * CORE
        low = np.maximum(core - LEAD, 0)
        high = np.minimum(core + CORE + LEAD, texts[of])
        order = np.argsort(low - high, kind="stable")
        for i in range(0, len(order), WINDOWS):
            rows = order[i : i + WINDOWS]
            sizes, start = (high - low)[rows], (bounds[of] + low)[rows]
            places = np.arange(sizes[0])
            inside = places[None, :] < sizes[:, None]
            windows = data[np.where(inside, start[:, None] + places, start[:, None])]
            p = self.probabilities(windows, sizes)
            own = (core - low)[rows]
            end = np.minimum(own + CORE, sizes)
            counted = (places[:, None] >= own) & (places[:, None] < end)
            np.add.at(pooled, of[rows], np.einsum("tln,tn->nl", p, counted.astype(np.float32)))
        return pooled / np.maximum(texts, 1)[:, None]


def is_held_out(doc_id):
    """Documents kept from the training: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(column(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs, train, doc_id, text, lang, rows, seed):
    """(language, hash, pieces) of the rows to learn from; see ``fit_language_id``."""
    known = docs.filter(train & column(lang).isNotNull() & column(text).isNotNull() & (column(text) != ""))
    digest = F.xxhash64(column(doc_id), column(text), column(lang), F.lit(seed)).alias("h")
    known = known.select(column(lang).alias("l"), digest, column(text).alias("t"))
    # The number of different rows need not be exact: it sets a rate that leaves twice as many as are taken.
    kinds = written_table(known.groupBy("l").agg(F.approx_count_distinct("h").alias("n")), "languages")
    of_each = min(rows, max(1, MOST_ROWS // max(kinds.count(), 1)))
    rates = kinds.select("l", F.least(F.lit(1.0), F.lit(2.0 * of_each) / F.col("n")).alias("rate"))
    share = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    size = F.length("t")
    step = F.greatest(F.floor(size / PIECES), F.lit(1)).cast("int")
    pieces = [F.substring("t", 1 + k * step, F.lit(PIECE_CHARS)) for k in range(PIECES)]
    cut = known.select("l", "h", share.alias("s"), F.array(*pieces).alias("p"))
    chosen = spread_join(cut, rates.withColumn("copies", F.lit(1)), "l", "copies").filter(F.col("s") < F.col("rate"))
    chosen = chosen.groupBy("l", "h").agg(F.first("p").alias("p"))
    least = Window.partitionBy("l").orderBy("h")
    chosen = chosen.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= of_each)
    return sorted((r.l, r.h, r.p) for r in chosen.collect())


def fit_language_id(docs, train, doc_id="doc_id", text="text", lang="lang", rows=ROWS_PER_LANGUAGE, seed=0):
    """A network trained on a bounded sample of the rows where ``train`` holds.

    The sample is the documented bound: at most ``rows`` rows of each language, and
    ``MOST_ROWS`` of all but for one of each, those with the least hashes of id, text and
    language, and of each row ``PIECES`` pieces of ``PIECE_CHARS`` characters. Only these
    reach the driver. Rows that repeat in all three are one there, so neither ids, which
    may all be equal or null, nor copies keep a language out. Rows without text or
    language teach nothing; with no rows at all the network knows no language.
    """
    with scratch(docs.sparkSession):
        found = sample(docs, train, doc_id, text, lang, rows, seed)
    languages = sorted({r[0] for r in found})
    network = ByteNetwork(languages, seed=seed)
    samples = [(languages.index(l), p.encode()[:PIECE_CHARS]) for l, _, ps in found for p in ps if p]
    if not samples:
        return network
    # Every language weighs the same, however many rows it has.
    each = np.bincount([l for l, _ in samples], minlength=len(languages))
    samples = [s for s in samples for _ in range(max(1, int(each.max() // each[s[0]])))]
    sizes = np.array([len(p) for _, p in samples])
    windows = np.array([list(p.ljust(PIECE_CHARS, b"\0")) for _, p in samples], np.uint8)
    return network.train(windows, sizes, np.array([l for l, _ in samples]), seed=seed)


def predict_language(docs, network, text="text", carry=None):
    """``docs`` with lang_pred and score, the language of the whole text and its share.

    Every byte gets a probability of each language from the network. It is run over
    windows of ``CORE`` bytes and not over the text from end to end: both directions
    start ``LEAD`` bytes outside of the window. The document's score is the mean over
    all its bytes, and equal scores go to the language that sorts first.

    A text that is null, empty or without a letter is ``und`` with score 0, as is
    every text when the network knows no language. Repeated rows get the same
    answer, long texts are read whole, and a column of ``docs`` with the name of
    a result gives way. Rows do not move.
    """

    def start():
        def compute(array):
            data, bounds = utf8(array)
            if not network.languages:
                return [pa.array([UNKNOWN] * len(array)), pa.array(np.zeros(len(array)))]
            pooled = network.score(data, bounds)
            best = pooled.argmax(axis=1)
            names = pa.array(network.languages, pa.string()).take(pa.array(best))
            return [names, pa.array(np.minimum(1.0, np.round(pooled.max(axis=1), 5)))]

        return compute

    letters = F.coalesce(column(text).rlike(r"\p{L}"), F.lit(False))
    fields = [("lang_pred", StringType()), ("score", DoubleType())]
    names = free_of(docs.columns if carry is None else carry, [n for n, _ in fields])
    rows = docs.select(packed(names), letters.alias("letters"), column(text).alias("text"))
    found = append_columns(rows, "text", fields, start, carry=["row", "letters"])
    known = {
        "lang_pred": F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNKNOWN),
        "score": F.when(F.col("letters"), F.col("score")).otherwise(0.0),
    }
    return unpacked(found.withColumns(known).drop("letters"), names)
