"""SentencePiece encoding and decoding by a max-plus parallel scan.

The ids of a text are those of its best-scored segmentation into the vocabulary's pieces
(what SentencePiece calls the unigram mode), in whole numbers, so sums are exact. A
character that no piece covers costs UNKNOWN and becomes its bytes.

A text has sure cuts: no piece holds a space behind another character, or a line feed. So
words between cuts are segmented alone, each different one once per process.

Giant documents are split into chunks. The state at a chunk's edge is how many characters
before the edge the last piece ended. A chunk yields the matrix of best scores from each
state at its left edge to each at its right edge; in max-plus algebra, matrices of
neighbouring chunks multiply associatively. They are multiplied per block of chunks, blocks
are scanned per document, the states inside each block follow, and then each chunk is
traced back on its own.

Normalisation is the model's: a space in front, spaces as U+2581, nothing else. So U+2581
in a text is decoded as a space; otherwise decoding gives the text back.

Defined cases: a NULL or empty text has no ids; equal giant texts are encoded once; NULL and
repeated doc_ids give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import cut, groups_of, has_columns, ship_package, shuffle_partitions
from stockflow.llm.encoding import TableEncoder
from stockflow.llm.shingles import text_slices

GIANT_CHARS = 32_768
CHUNK_CHARS = 16_384
BLOCK_CHUNKS = 64
NEVER = -(1 << 60)
SPACE = "▁"


class Pieces(TableEncoder):
    """The vocabulary of a SentencePiece model file."""

    def __init__(self, model: str):
        from sentencepiece import sentencepiece_model_pb2

        super().__init__()
        proto = sentencepiece_model_pb2.ModelProto()
        with open(model, "rb") as source:
            proto.ParseFromString(source.read())
        normal, byte = 1, 6  # types of pieces in the file format
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == normal}
        own = [p.score for p in proto.pieces if p.type == normal and p.score > -1e6]
        # pieces the model never joins to (its runs of spaces) rank behind all others
        self.unknown = int(min(own)) - 10
        score = {i: max(int(p.score), self.unknown) for i, p in enumerate(proto.pieces)}
        self.bytes = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == byte:
                value = int(p.piece[1:-1], 16)
                self.bytes[value] = i
                # a character costs the same however many bytes it has
                score[i] = 0 if 0x80 <= value < 0xC0 else self.unknown
        self.scores = np.array([score[i] for i in range(len(proto.pieces))], np.int64)
        self.longest = max(map(len, self.ids))
        # the score of each piece; None for what only begins one
        self._begun: dict[str, int | None] = {p[:n]: None for p in self.ids for n in range(1, len(p))}
        self._begun |= {p: score[i] for p, i in self.ids.items()}
        # the same for what ends one
        self._ended: dict[str, int | None] = {p[n:]: None for p in self.ids for n in range(1, len(p))}
        self._ended |= {p: score[i] for p, i in self.ids.items()}
        self.text = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == byte else p.piece.replace(SPACE, " ").encode()
            for p in proto.pieces
        ]
        if any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in self.ids):
            raise ValueError("a piece goes across spaces or lines: texts have no sure cuts")

    # -- one stretch of text, escaped: a plain forward pass ---------------------------

    def steps(self, text: str, at: int) -> Iterator[tuple[int, int]]:
        """End and score of each piece that starts at ``at``; the first may be unknown."""
        begun = self._begun
        if begun.get(text[at]) is None:
            yield at + 1, self.unknown
        for end in range(at + 1, len(text) + 1):
            score = begun.get(text[at:end], NEVER)
            if score == NEVER:
                return
            if score is not None:
                yield end, score

    def best_path(self, text: str, start: int, stop: int, beyond: int = 0) -> tuple[int, list[int]]:
        """Score and ids of the best segmentation of text[start:stop]; the first piece must
        end behind ``beyond``."""
        begun, unknown = self._begun, self.unknown
        best = [NEVER] * (stop - start + 1)
        came = [0] * (stop - start + 1)
        best[0] = 0
        for at in range(start, stop):
            here = best[at - start]
            if here == NEVER:
                continue
            # the loop of ``steps``, written out
            least = beyond if at == start else at
            if begun.get(text[at]) is None and at + 1 > least and here + unknown > best[at - start + 1]:
                best[at - start + 1], came[at - start + 1] = here + unknown, at
            for end in range(at + 1, stop + 1):
                score = begun.get(text[at:end], NEVER)
                if score is None:
                    continue
                if score == NEVER:
                    break
                if here + score > best[end - start] and end > least:
                    best[end - start], came[end - start] = here + score, at
        if best[-1] == NEVER:
            return NEVER, []
        return best[-1], self._ids_back(text, start, stop, came)

    def _ids_back(self, text: str, start: int, stop: int, came: list[int]) -> list[int]:
        """The ids of text[start:stop], of which ``came`` says where the piece to each place starts."""
        ids: list[int] = []
        end = stop
        parts = []
        while end > start:
            parts.append(text[came[end - start] : end])
            end = came[end - start]
        for part in reversed(parts):
            found = self.ids.get(part)
            ids += [found] if found is not None else [self.bytes[b] for b in part.encode()]
        return ids

    # -- many texts: a table of words ---------------------------------------------------

    def _ids_of_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The best path of each word, as ``best_path`` finds it. Words are taken in order, and
        what the one before has in common with a word is not gone through again."""
        texts = [piece.decode().replace(" ", SPACE) for piece in pieces]
        found: list[list[int]] = [[]] * len(texts)
        ending, unknown = self._ended.get, self.unknown
        before, best, came = "", [0], [0]
        for i in sorted(range(len(texts)), key=texts.__getitem__):
            text = texts[i]
            same, least = 0, min(len(before), len(text))
            while same < least and before[same] == text[same]:
                same += 1
            del best[same + 1 :], came[same + 1 :]
            for end in range(same + 1, len(text) + 1):
                first = at = end - 1
                score = ending(text[at], NEVER)
                if score is None or score == NEVER:
                    top = best[at] + unknown
                else:
                    top = best[at] + score
                if score != NEVER:
                    while at:
                        at -= 1
                        score = ending(text[at:end], NEVER)
                        if score is None:
                            continue
                        if score == NEVER:
                            break
                        # of equal ones the longest last piece
                        score += best[at]
                        if score >= top:
                            top, first = score, at
                best.append(top)
                came.append(first)
            before = text
            found[i] = self._ids_back(text, 0, len(text), came)
        return found

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        space, line = data == 32, data == 10
        mark = space.copy()
        mark[1:] &= ~space[:-1]
        mark |= line
        mark[1:] |= line[:-1]
        mark[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        return np.flatnonzero(mark)

    def encode_documents(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Ids and offsets of texts, and the texts as they should be decoded, as bytes and offsets."""
        for data, edges in text_slices(texts):
            if (data == 0xE2).any():
                raw = data.tobytes()
                parts = [
                    raw[a:b].replace(SPACE.encode(), b" ") for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
                ]
                data = np.frombuffer(b"".join(parts), np.uint8)
                edges = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)
            some = np.diff(edges) > 0
            led = np.insert(data, edges[:-1][some], 32)
            led_edges = edges + np.concatenate([[0], np.cumsum(some)])
            ids, offsets = self.encode_bytes(led, led_edges)
            yield ids, offsets, data, edges

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids with the leading space still there."""
        return b"".join(map(self.text.__getitem__, ids.tolist()))

    # -- chunks of a giant text -----------------------------------------------------------

    def sure_cuts(self, text: str, first: int) -> tuple[int, int] | None:
        """The first and the last sure cut of an escaped text, from ``first`` on."""

        def sure(at: int) -> bool:
            return at > 0 and (
                text[at] == "\n" or text[at - 1] == "\n" or (text[at] == SPACE and text[at - 1] != SPACE)
            )

        low = next((at for at in range(max(first, 1), len(text)) if sure(at)), None)
        if low is None:
            return None
        return low, next(at for at in range(len(text) - 1, low - 1, -1) if sure(at))

    def transfer(self, text: str, left: int) -> np.ndarray:
        """Best scores from states at the left edge to states at the right edge.

        ``text`` is the escaped chunk with ``left`` characters before it. State j is a piece's
        end j characters before the edge and none between there and the edge.
        """
        n, size = len(text), self.longest
        cuts = self.sure_cuts(text, left)
        if cuts is None:
            return self._spread(text, left, left, n)
        low, high = cuts
        head = self._spread(text, left, left, low)[:, 0]
        tail = self._spread(text, left, high, n)[0]
        ids, _ = self.encode_bytes(*_as_bytes(text[low:high]))
        matrix = head[:, None] + tail[None, :] + int(self.scores[ids].sum())
        matrix[(head == NEVER)[:, None] | (tail == NEVER)[None, :]] = NEVER
        return matrix.reshape(size, size)

    def _spread(self, text: str, left: int, start: int, stop: int) -> np.ndarray:
        """Scores from states at ``start`` (reaching back to ``left`` at most) to states at ``stop``."""
        size = self.longest
        back = min(size - 1, left) if left == start else 0
        # a row per place from start - back on: the best score from each state
        table = np.full((stop - start + back + 1, size), NEVER, np.int64)
        for j in range(back + 1):
            table[back - j, j] = 0
        for at in range(start - back, stop):
            here = table[at - start + back]
            if (here == NEVER).all():
                continue
            for end, score in self.steps(text, at):
                # what starts before the edge must end behind it
                if end <= stop and (at >= start or end > start):
                    row = table[end - start + back]
                    np.maximum(row, np.where(here == NEVER, NEVER, here + score), out=row)
        result = np.full((size, size), NEVER, np.int64)
        for k in range(size):
            place = stop - k
            if place >= start:
                result[:, k] = table[place - start + back]
        return result

    def trace(self, text: str, left: int, state_in: int, state_out: int) -> list[int]:
        """The ids of the best path between two states: pieces that start before the right one."""
        start, stop = left - state_in, len(text) - state_out
        cuts = self.sure_cuts(text, left)
        if cuts is None:
            return self.best_path(text, start, stop, left if state_in else 0)[1]
        low, high = cuts
        head = self.best_path(text, start, low, left if state_in else 0)[1]
        ids, _ = self.encode_bytes(*_as_bytes(text[low:high]))
        return head + ids.tolist() + self.best_path(text, high, stop)[1]


def _as_bytes(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = text.replace(SPACE, " ").encode()
    return np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of two matrices."""
    total = np.where((a[:, :, None] == NEVER) | (b[None, :, :] == NEVER), NEVER, a[:, :, None] + b[None, :, :])
    return total.max(axis=1)


def states_between(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """The states at all edges of a best path through the matrices, given both ends."""
    size = len(matrices[0])
    best = np.full(size, NEVER, np.int64)
    best[first] = 0
    came = []
    for matrix in matrices:
        total = np.where((best[:, None] == NEVER) | (matrix == NEVER), NEVER, best[:, None] + matrix)
        came.append(total.argmax(axis=0))
        best = total.max(axis=0)
    states = [last]
    for choices in reversed(came):
        states.append(int(choices[states[-1]]))
    return states[::-1]


_vocabularies: dict[str, Pieces] = {}


def vocabulary(model: str) -> Pieces:
    """The vocabulary of a model file in this process."""
    if model not in _vocabularies:
        _vocabularies[model] = Pieces(model)
    return _vocabularies[model]


_ENCODED_DDL = "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean, ids binary"


def _encode_small(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            done = 0
            for ids, offsets, data, edges in pieces.encode_documents(batch.column(1)):
                n = len(offsets) - 1
                decoded = np.frombuffer(pieces.decode(ids), np.uint8)
                # every text that is not empty starts with the space that was put before it
                some = np.diff(edges) > 0
                plain = np.delete(decoded, (edges[:-1] + np.cumsum(some) - some)[some]) if len(decoded) == len(data) + some.sum() else decoded
                same = len(plain) == len(data)
                raw = ids.astype("<u4").tobytes()
                crcs, texts, trips = [], [], []
                for a, b, c, d in zip(offsets[:-1].tolist(), offsets[1:].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    crcs.append(zlib.crc32(raw[4 * a : 4 * b]))
                    own = plain[c:d] if same else decoded[:0]
                    texts.append(zlib.crc32(own.tobytes()))
                    trips.append(same and bool((own == data[c:d]).all()))
                parts = [raw[4 * a : 4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, n),
                        pa.array(np.diff(offsets)),
                        pa.array(crcs, pa.int64()),
                        pa.array(texts, pa.int64()),
                        pa.array(trips),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "round_trip", "ids"],
                )
                done += n

    return run


def _split(longest: int, chunk_chars: int):
    """key, text -> chunks, each with the characters before it that a piece may reach back to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = SPACE + text.replace(" ", SPACE)
                starts = range(0, len(text), chunk_chars)
                for no, start in enumerate(starts):
                    left = min(start, longest - 1)
                    part = text[start - left : start + chunk_chars]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key], pa.binary()), pa.array([no]), pa.array([len(starts)]), pa.array([left]), pa.array([part])],
                        names=["key", "no", "n_chunks", "left", "part"],
                    )

    return run


def _giant_ids(giants: DataFrame, model: str, chunk_chars: int) -> DataFrame:
    """Ids of giant texts, chunk by chunk: key, no, ids."""
    spark = giants.sparkSession
    n, longest = shuffle_partitions(spark), vocabulary(model).longest
    size = longest

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            found = [
                pieces.transfer(part, left).tobytes()
                for part, left in zip(batch.column("part").to_pylist(), batch.column("left").to_pylist(), strict=True)
            ]
            kept = [batch.column(name) for name in ("key", "no", "n_chunks")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], names=["key", "no", "n_chunks", "matrix"])

    def read(table: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(one, np.int64).reshape(size, size) for one in table.column("matrix").to_pylist()]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups_of(batches, "unit"):
            total = None
            for matrix in read(block):
                total = matrix if total is None else times(total, matrix)
            first = block.slice(0, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    first.column("key").combine_chunks(),
                    pa.array([first.column("no")[0].as_py() // BLOCK_CHUNKS]),
                    pa.array([total.tobytes()], pa.binary()),
                ],
                names=["key", "block", "matrix"],
            )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text in groups_of(batches, "key"):
            states = states_between(read(text), 0, 0)
            yield pa.RecordBatch.from_arrays(
                [text.column("key").combine_chunks(), text.column("block").combine_chunks(), pa.array(states[:-1]), pa.array(states[1:])],
                names=["key", "block", "enters", "leaves"],
            )

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups_of(batches, "unit"):
            states = states_between(read(block), block.column("enters")[0].as_py(), block.column("leaves")[0].as_py())
            yield pa.RecordBatch.from_arrays(
                [block.column("key").combine_chunks(), block.column("no").combine_chunks(), pa.array(states[:-1]), pa.array(states[1:])],
                names=["key", "no", "enters", "leaves"],
            )

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("part", "left", "enters", "leaves")]
            ids = [np.array(pieces.trace(*row), "<u4").tobytes() for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("no"), pa.array(ids, pa.binary())], names=["key", "no", "ids"])

    unit = F.concat("key", F.encode(F.concat(F.lit(","), F.floor(F.col("no") / BLOCK_CHUNKS)), "utf-8")).alias("unit")
    chunks = cut(
        giants.mapInArrow(_split(longest, chunk_chars), "key binary, no long, n_chunks long, left long, part string").repartition(n, "key", "no")
    )
    scored = cut(chunks.mapInArrow(matrices, "key binary, no long, n_chunks long, matrix binary").select("*", unit))
    blocks = scored.repartition(n, "unit").sortWithinPartitions("unit", "no").mapInArrow(products, "key binary, block long, matrix binary")
    edges = (
        blocks.repartition(n, "key").sortWithinPartitions("key", "block").mapInArrow(scan, "key binary, block long, enters long, leaves long")
    )
    with_edges = scored.join(edges, (scored["key"] == edges["key"]) & (F.floor(F.col("no") / BLOCK_CHUNKS) == F.col("block"))).select(
        "unit", scored["key"], "no", "matrix", "enters", "leaves"
    )
    states = (
        with_edges.repartition(n, "unit").sortWithinPartitions("unit", "no").mapInArrow(inside, "key binary, no long, enters long, leaves long")
    )
    return chunks.join(states, ["key", "no"]).mapInArrow(traced, "key binary, no long, ids binary")


def encode_documents(
    docs: DataFrame, model: str, giant_chars: int = GIANT_CHARS, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_crc32, decoded_crc32 (checksums of the ids
    as little-endian 32-bit numbers, and of the text decoded from them), round_trip (whether that is
    the text), ids. Chunks must be longer than the longest piece."""
    ship_package(docs.sparkSession)
    rows = has_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    giant = F.length("text") > giant_chars
    small = rows.where(~giant).mapInArrow(_encode_small(model), _ENCODED_DDL)
    keyed = rows.where(giant).withColumn("key", F.unhex(F.md5("text")))
    n = shuffle_partitions(docs.sparkSession)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for text in groups_of(batches, "key"):
            ids = b"".join(text.column("ids").to_pylist())
            decoded = pieces.decode(np.frombuffer(ids, "<u4"))[1:]
            yield pa.RecordBatch.from_arrays(
                [
                    text.column("key").slice(0, 1).combine_chunks(),
                    pa.array([len(ids) // 4]),
                    pa.array([zlib.crc32(ids)]),
                    pa.array([zlib.crc32(decoded)]),
                    pa.array([len(decoded)]),
                    pa.array([ids], pa.binary()),
                ],
                names=["key", "n_tokens", "ids_crc32", "decoded_crc32", "n_bytes", "ids"],
            )

    found = (
        _giant_ids(keyed.select("key", "text").dropDuplicates(["key"]), model, chunk_chars)
        .repartition(n, "key")
        .sortWithinPartitions("key", "no")
        .mapInArrow(joined, "key binary, n_tokens long, ids_crc32 long, decoded_crc32 long, n_bytes long, ids binary")
    )
    plain = F.replace("text", F.lit(SPACE), F.lit(" "))
    sources = keyed.select("doc_id", "key", F.crc32(plain).alias("crc"), F.octet_length(plain).alias("size"))
    large = sources.join(found, "key").select(
        "doc_id",
        "n_tokens",
        "ids_crc32",
        "decoded_crc32",
        ((F.col("crc") == F.col("decoded_crc32")) & (F.col("size") == F.col("n_bytes"))).alias("round_trip"),
        "ids",
    )
    return small.unionByName(large)
