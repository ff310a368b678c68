"""Token counts of texts by a SentencePiece BPE model, one count for each distinct pre-token."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from plumbline.llm.arrow import TEXT, column, free_of
from plumbline.llm.arrow import packed as packed_row
from plumbline.llm.arrow import unpacked as unpacked_row
from plumbline.session import scratch, written_table

SPACE = "▁"
#: Letters that no piece of the known vocabularies joins to anything else.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
FINE = f"{SPACE}*(?:[{LETTERS}]+|[^{LETTERS}{SPACE}]+)|{SPACE}+"
COARSE = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
#: Texts that share one list of their distinct pre-tokens, in characters, or one longer text.
BLOCK_CHARS = 32_000_000


def pre_token_pattern(pieces):
    """The finest known pattern whose pre-tokens no piece of the vocabulary crosses.

    A merge joins two neighbours only where the result is a piece, so what lies
    between two pre-tokens is never joined and each can be counted by itself.
    """
    for pattern in (FINE, COARSE):
        found = re.compile(pattern)
        if all(found.fullmatch(p) for p in pieces):
            return pattern
    raise ValueError("pieces of this vocabulary join words, so no pre-token stands by itself")


class PieceCounter:
    """Pre-tokens of texts and pieces of pre-tokens by a model; made once in each task."""

    def __init__(self, model_file):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        m, ids = self.model, range(self.model.get_piece_size())
        ordinary = [m.id_to_piece(i) for i in ids if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i))]
        if m.encode("  a", out_type=str) != m.encode(" a".replace(" ", SPACE * 2), out_type=str):
            raise ValueError("the model must mark and keep every space")
        self.find = re.compile(pre_token_pattern(ordinary)).findall

    def frequencies(self, text):
        """Pre-tokens of one text with their numbers; the model puts one space in front."""
        return Counter(self.find(SPACE + text.replace(" ", SPACE))) if text else Counter()

    def pieces(self, tokens):
        """The number of pieces of each pre-token."""
        # The model itself puts a space in front of what begins with none, so a
        # pre-token's own first one is taken off. A pre-token without one, or of
        # that alone, is counted behind a line break, which is a piece by itself.
        led = [t[0] == SPACE and len(t) > 1 for t in tokens]
        texts = [t[1:] if yes else "\n" + t for t, yes in zip(tokens, led)]
        alone = len(self.model.encode("\n"))
        return [len(ids) - (0 if yes else alone) for yes, ids in zip(led, self.model.encode(texts, num_threads=1))]


def packed(places, numbers):
    """Frequencies as bytes: differences of the places in order, by byte planes, then
    the numbers, a byte each. A number above 255 is several entries of one place.
    """
    order = np.argsort(places)
    places, numbers = places[order], numbers[order]
    if len(numbers) and numbers.max() > 255:
        times = -(-numbers // 255)
        last = np.cumsum(times) - 1
        rest = numbers - 255 * (times - 1)
        places, numbers = np.repeat(places, times), np.full(last[-1] + 1, 255)
        numbers[last] = rest
    return np.diff(places, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() + numbers.astype(np.uint8).tobytes()


def unpacked(raw):
    """Places and numbers of ``packed``."""
    planes = np.frombuffer(raw, np.uint8).reshape(5, -1)
    return np.cumsum(np.ascontiguousarray(planes[:4].T).view("<u4").ravel()), planes[4]


def frequency_blocks(rows, model_file, block_chars):
    """Rows of texts, and rows of blocks, told apart by the column tokens.

    A row of a text has its block and its packed frequencies, by place in the
    block's distinct pre-tokens; a row of a block has these, as tokens.
    """
    new = [("block", LongType()), ("packed", BinaryType()), ("tokens", ArrayType(StringType()))]
    carried = [StructField(f.name, f.dataType) for f in rows.schema.fields if f.name != TEXT]
    schema = StructType(carried + [StructField(n, t) for n, t in new])

    def run(batches):
        counter, number = PieceCounter(model_file), TaskContext.get().partitionId() << 32
        places = defaultdict()
        places.default_factory = places.__len__
        size = 0

        def closed():
            kinds = [f.type for f in kept.schema]
            columns = [pa.nulls(1, k) for k in kinds] + [pa.array([number]), pa.nulls(1, pa.binary())]
            return pa.RecordBatch.from_arrays([*columns, pa.array([list(places)], pa.list_(pa.string()))], names=schema.names)

        kept = None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            kept = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            low, out = 0, []
            for at, text in enumerate(texts.to_pylist()):
                found = counter.frequencies(text)
                out.append(
                    packed(
                        np.fromiter(map(places.__getitem__, found), np.int64, len(found)),
                        np.fromiter(found.values(), np.int64, len(found)),
                    )
                )
                size += len(text or "")
                if size >= block_chars or at + 1 == batch.num_rows:
                    part = kept.slice(low, at + 1 - low)
                    n = part.num_rows
                    made = [pa.array([number] * n, pa.int64()), pa.array(out, pa.binary())]
                    made.append(pa.nulls(n, pa.list_(pa.string())))
                    yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.names)
                    low, out = at + 1, []
                if size >= block_chars:
                    yield closed()
                    places.clear()
                    number, size = number + 1, 0
        if places:
            yield closed()

    return rows.mapInArrow(run, schema)


def count_tokens(docs, model_file, text="text", limit=4096, carry=None, block_chars=BLOCK_CHARS):
    """``docs`` with n_bytes, n_tokens and over_limit of each whole text.

    Every text becomes pre-token frequencies. The distinct pre-tokens of all texts
    are counted once each by the model, joined to the frequencies and summed, so no
    ids of a text are ever made. Frequencies are packed for the join: texts of a
    block, about ``block_chars`` characters in one task, share a list of their
    distinct pre-tokens, and only these lists meet the counts. So a pre-token has
    at most one row for each block, however frequent it is, and the counts of a
    block's list return to its texts by the block's number.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted
    each. A text of any length is read whole. A column of ``docs`` that has the
    name of a result gives way; an empty table gives an empty one.
    """
    made = ["n_bytes", "n_tokens", "over_limit"]
    kept = free_of(docs.columns if carry is None else carry, made)
    size = F.coalesce(F.octet_length(column(text)), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(packed_row(kept), size, column(text).alias(TEXT))

    def counted(batches):
        counter = PieceCounter(model_file)
        for batch in batches:
            pieces = pa.array(counter.pieces(batch.column(0).to_pylist()), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pieces], names=["token", "pieces"])

    def summed(texts, counts):
        found = counts.column("found").to_numpy()
        at = found & 0xFFFFFFFF
        known = np.ones(at.max(initial=-1) + 1, np.int64)
        known[at] = found >> 32
        totals = []
        for raw in texts.column("packed").to_pylist():
            places, numbers = unpacked(raw)
            if len(places):
                known = np.pad(known, (0, max(0, int(places[-1]) + 1 - len(known))), constant_values=1)
            totals.append(int((known[places] * numbers).sum()))
        columns = [texts.column("row"), texts.column("n_bytes"), pa.array(totals, pa.int64())]
        return pa.table(columns, names=["row", "n_bytes", "n_tokens"])

    with scratch(docs.sparkSession) as keep:
        blocks = frequency_blocks(rows, model_file, block_chars)
        blocks = written_table(blocks, "token-blocks", compression="zstd")
        words = blocks.filter("tokens IS NOT NULL").select("block", F.posexplode("tokens").alias("place", "token"))
        pieces = words.select("token").distinct().mapInArrow(counted, "token string, pieces int")
        pieces = written_table(pieces, "token-pieces", compression="zstd")
        # Place and pieces travel as one number; a pre-token that is one piece needs none.
        found = F.shiftleft(F.col("pieces").cast("long"), 32) + F.col("place")
        counts = words.join(pieces, "token").filter("pieces <> 1").select(F.col("block").alias("of"), found.alias("found"))
        texts = blocks.filter("packed IS NOT NULL").select("block", "row", "n_bytes", "packed")
        schema = StructType([texts.schema["row"], texts.schema["n_bytes"], StructField("n_tokens", LongType())])
        found = texts.groupBy("block").cogroup(counts.groupBy("of")).applyInArrow(summed, schema)
        return keep(unpacked_row(found.withColumn("over_limit", F.col("n_tokens") > limit), kept), "token-counts")
