"""Max-plus encoding against a plain forward pass over whole texts, and exact round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stockflow.llm import piece_scan
from stockflow.llm.encoding import public_vocabulary
from stockflow.llm.queries import PIECE_MODEL, QUERIES
from tests.conftest import SMALL

MODEL = public_vocabulary(PIECE_MODEL)
ODD = ["", " ", "a", "  a   b ", "\n", "\n\nx\n", "a\nb", "日本語 と ☃ x", "é" * 40, "x" * 300, " " * 50, "end "]


def whole(text: str) -> list[int]:
    escaped = (" " + text if text else "").replace(" ", piece_scan.SPACE)
    return piece_scan.vocabulary(MODEL).best_path(escaped, 0, len(escaped))[1]


def random_text(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(["the", "ing ", " ", "a", "qu", "\n", "é", "☃", "er", "station", "xyz"]) for _ in range(n))


def score(ids) -> int:
    return int(piece_scan.vocabulary(MODEL).scores[np.array(ids, np.int64)].sum()) if len(ids) else 0


def test_tables_of_words_equal_whole_texts():
    rng = random.Random(1)
    texts = ODD + [random_text(rng, rng.randint(0, 60)) for _ in range(200)]
    pieces, found = piece_scan.vocabulary(MODEL), []
    for ids, offsets, _, _ in pieces.encode_documents(pa.array(texts)):
        found += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert [score(one) for one in found] == [score(whole(text)) for text in texts]
    assert [pieces.decode(np.array(one, np.int64))[1:].decode() for one in found] == texts


@pytest.mark.parametrize("alphabet", ["the station er ing\n", "theinstaoxq☃"])
def test_transfer_matrices_are_best_scores(alphabet):
    """Chunks of texts with and without sure cuts: the product is the score of the whole."""
    rng, pieces = random.Random(2), piece_scan.vocabulary(MODEL)
    for _ in range(30):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(70, 160))).replace(" ", piece_scan.SPACE)
        size, matrices, parts = rng.randint(17, 50), [], []
        for start in range(0, len(text), size):
            left = min(start, pieces.longest - 1)
            parts.append((text[start - left : start + size], left))
            matrices.append(pieces.transfer(*parts[-1]))
        expected, _ = pieces.best_path(text, 0, len(text))
        total = matrices[0]
        for matrix in matrices[1:]:
            total = piece_scan.times(total, matrix)
        assert total[0, 0] == expected
        states = piece_scan.states_between(matrices, 0, 0)
        ids = [one for part, a, b in zip(parts, states, states[1:]) for one in pieces.trace(*part, a, b)]
        assert score(ids) == expected
        assert pieces.decode(np.array(ids)).decode() == text.replace(piece_scan.SPACE, " ")


def test_best_score_equals_the_library_in_unigram_mode():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as source:
        proto.ParseFromString(source.read())
    proto.trainer_spec.model_type = 1
    pieces = piece_scan.vocabulary(MODEL)
    for i, piece in enumerate(proto.pieces):
        if piece.type == 1:
            piece.score = max(piece.score, pieces.unknown)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    rng = random.Random(3)
    for _ in range(100):
        text = " ".join(rng.choice(["station", "the", "anding", "queer", "xylo", "tion"]) for _ in range(rng.randint(1, 12)))
        assert score(library.encode(text)) == score(whole(text))


def test_giant_documents_equal_whole_texts(spark):
    rng = random.Random(4)
    texts = [random_text(rng, 400), random_text(rng, 300), "x" * 900, None, "", "short", "日本" * 300, "a ▁ b" * 200]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, texts[0]), (1, texts[1]), (1, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "1 as key")
    found = piece_scan.encode_documents(docs, MODEL, giant_chars=200, chunk_chars=64).collect()
    assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in found) == sorted((i or 0, bool(t)) for i, t in rows)
    for row in found:
        text = (texts[row.doc_id] if row.doc_id is not None else texts[0]) or ""
        text = text.replace(piece_scan.SPACE, " ")
        ids = np.frombuffer(row.ids, "<u4")
        assert row.round_trip and row.decoded_crc32 == zlib.crc32(text.encode())
        assert row.ids_crc32 == zlib.crc32(row.ids) and row.n_tokens == len(ids)
        assert score(ids) == score(whole(text))


def test_all_documents_come_back(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = piece_scan.encode_documents(docs, MODEL, giant_chars=4000, chunk_chars=1000)
    assert found.where("round_trip").count() == docs.count()
    assert piece_scan.encode_documents(docs.limit(0), MODEL).count() == 0


def test_the_query_returns_the_ids(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    found = QUERIES["op9_piece_scan"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = np.frombuffer(row.ids, "<u4")
        assert len(ids) == row.n_tokens and zlib.crc32(row.ids) == row.ids_crc32
        plain = (texts[row.doc_id] or "").replace(piece_scan.SPACE, " ")
        assert piece_scan.vocabulary(MODEL).decode(ids)[1:].decode() == plain


def test_words_with_a_common_beginning_share_its_path():
    class Counted(dict):
        looks = 0

        def get(self, *key):
            self.looks += 1
            return super().get(*key)

    pieces = piece_scan.Pieces(MODEL)
    words = [f" understand{end}".encode() for end in ("", "a", "able", "ing", "ings", "é", "▁x", "\n")] + [b" stand", b"x"]
    texts = [word.decode().replace(" ", piece_scan.SPACE) for word in words]
    pieces._ended = Counted(pieces._ended)
    alone = [pieces._ids_of_pieces([word])[0] for word in words]
    looks, pieces._ended.looks = pieces._ended.looks, 0
    assert pieces._ids_of_pieces(words) == alone == [pieces.best_path(text, 0, len(text))[1] for text in texts]
    assert 3 * pieces._ended.looks < looks
