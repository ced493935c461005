"""Token files and the BPE transducer, against the libraries."""

from __future__ import annotations

import base64
import io
import random
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tiermill.llm import bitplanes, bpe_fst, queries, segments
from tiermill.llm.segments import PieceCache, pieces_of

RANKS = queries.tokenizer_file("byte_bpe_50k.tiktoken")
LETTERS = "abcdefghij the  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　.,!?'s'll0123é漢字🙂ßA"


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe_fst.PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(seed, count, longest=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, longest))) for _ in range(count)]


def test_transducer_equals_the_library(library):
    plain = "abcdefgh the  \n\t.,!?|#$%&*()5²½ ªµé\xa0\x85\x1c\x1fßĳǅ·"
    texts = noise(1, 3000) + ["".join(random.Random(i).choices(plain, k=i % 40)) for i in range(3000)]
    assert bpe_fst._encode_column(pa.array(texts), RANKS).to_pylist() == [library.encode_ordinary(t) for t in texts]


def test_a_long_piece_streams(library):
    rnd = random.Random(2)
    piece = "".join(rnd.choice("abcxyzthequ") for _ in range(40_000))
    transducer = bpe_fst.Transducer(bpe_fst.Vocabulary.load(RANKS))
    assert transducer.encode(piece.encode()) == library.encode_ordinary(piece)
    assert list(transducer.stream(piece[:5000].encode(), block=64)) == library.encode_ordinary(piece[:5000])


def test_few_states_change_nothing(library):
    transducer = bpe_fst.Transducer(bpe_fst.Vocabulary.load(RANKS), most_states=20)
    for text in ("hello", "thereforewhichever", "internationalization", "qqqqqq"):
        assert transducer.encode(text.encode()) == library.encode_ordinary(text)


def test_decoder_holds_unfinished_characters():
    data = "aé漢🙂\U0010ffffz".encode()
    for size in range(1, 6):
        decoder = bpe_fst.StreamDecoder([])
        parts = [decoder.feed_bytes(data[i : i + size]) for i in range(0, len(data), size)]
        assert "".join(parts) + decoder.finish() == data.decode()
    decoder = bpe_fst.StreamDecoder([b"\xf0\x9f", b"x"])
    assert decoder.feed([0]) == "" and decoder.feed([1]) == "�x"


def test_bpe_query(spark, small, documents, library):
    found = {r.doc_id: r for r in queries.op6_bpe_fst(spark, small).collect()}
    for row in documents.collect():
        ids = library.encode_ordinary(row.text or "")
        mine = found[row.doc_id]
        assert (mine.n_tokens, mine.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
        assert mine.decoded_sha256 == brute.sha(library.decode_bytes(ids))


def test_bpe_of_odd_tables(odd, nothing, library):
    for row in bpe_fst.decode_bpe(bpe_fst.encode_bpe(odd, RANKS), RANKS, text="back").collect():
        assert row.ids == library.encode_ordinary(row.text or "") and row.back == (row.text or "")
    assert bpe_fst.round_trip(nothing, RANKS).count() == 0
    assert bpe_fst.round_trip(odd, RANKS).filter(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0


def test_pieces_join_to_the_text_and_old_ones_come_back():
    asked = []

    def encode(pieces, _):
        asked.extend(pieces)
        return [p.encode("utf-32-le") for p in pieces]

    cache = PieceCache(encode, entries=2)
    for text in noise(3, 50):
        assert cache.ids([text, None]) == [text.encode("utf-32-le"), b""]
        assert "".join(pieces_of(text)) == text
    cache.ids(["same same"])
    before = len(asked)
    cache.ids(["same same"])
    assert len(asked) == before


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("top", [1, 200, 70_000, (1 << 32) - 1])
def test_planes_come_back(unit, top):
    ids = np.random.default_rng(top).integers(0, top, 1001, dtype=np.uint64, endpoint=True).astype(np.uint32)
    planes = bitplanes.split_planes(ids, unit)
    assert (bitplanes.join_planes(planes, len(ids), unit) == ids).all()
    assert len(planes) <= (4 if unit == "byte" else 32)


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_file_is_read_by_its_index(unit):
    out = io.BytesIO()
    writer = bitplanes.PlaneWriter(out, unit, block=100)
    docs = [(i if i else None, np.arange(i * 7, dtype=np.uint32) * 3) for i in range(40)]
    for doc, ids in docs:
        writer.add(doc, ids)
    writer.close()

    class Source:
        def size(self):
            return len(out.getvalue())

        def read_at(self, n, at):
            return out.getvalue()[at : at + n]

    reader = bitplanes.PlaneReader(Source())
    assert reader.doc_ids == [doc for doc, _ in docs] and out.getvalue().startswith(bitplanes.MAGIC)
    for i, (_, ids) in enumerate(docs):
        assert (reader.ids(reader.offsets[i], reader.offsets[i + 1]) == ids).all()


def check_files(found, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    start = 0
    rows = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    for mine, row in zip(sorted(found, key=lambda r: r.start), rows, strict=True):
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (mine.doc_id, mine.start, mine.n_tokens, mine.ids_crc32) == (row.doc_id, start, len(ids), crc)
        start += len(ids)


def test_token_file_query(spark, small, documents):
    check_files(queries.op2_bitplanes(spark, small).collect(), documents.collect())


def test_token_files_of_odd_tables(odd, nothing):
    files = bitplanes.write_ids(odd, queries.tokenizer_file("byte_bpe_50k.json"), 0, unit="bit")
    back = bitplanes.read_ids(files).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    check_files(back.collect(), odd.collect())
    row = files.orderBy("part").first()
    assert len(bitplanes.read_slice(odd.sparkSession, row.file, 0, 1)) == 1
    assert bitplanes.read_ids(bitplanes.write_ids(nothing, queries.tokenizer_file("byte_bpe_50k.json"), 0)).count() == 0


def test_files_are_read_in_as_many_tasks_as_there_are_partitions(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").repartitionByRange(4, "doc_id")
    files = bitplanes.write_ids(documents, queries.tokenizer_file("byte_bpe_50k.json"), 0)
    back = bitplanes.read_ids(files)
    assert back.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rows_of_one_id_are_dealt_over_files_in_order_of_their_texts(spark):
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        check_one_id(spark)
    finally:
        spark.conf.unset(merge)


def check_one_id(spark):
    rows = spark.range(2000).selectExpr("cast(null as bigint) doc_id", "concat('text ', id) text")
    files = bitplanes.write_ids(rows, queries.tokenizer_file("byte_bpe_50k.json"), 0)
    found = bitplanes.read_ids(files)
    assert files.count() > 1
    check_files(found.selectExpr("doc_id", "start", "octet_length(ids) div 4 n_tokens", "crc32(ids) ids_crc32").collect(), rows.collect())


def test_pieces_of_many_texts_are_cut_and_looked_up_as_arrays(monkeypatch):
    """As one by one, also where texts are cut into slices; each distinct piece is asked for once, no text is cut by itself."""
    letters = ["ab1 \n\t\r.,-\x1c\x00é\xa0\x85üɏ\xb2\xd7 ", "ab '_.\n é"]
    draw = random.Random(5)
    texts = [None, "", "x" * 70] + ["".join(draw.choices(letters[i % 2], k=draw.randint(1, 30))) for i in range(600)]
    want = list(chain.from_iterable(pieces_of(text or "") for text in texts))
    monkeypatch.setattr(segments, "pieces_of", None)
    for at_once in (segments.CHARS_AT_ONCE, 40):
        monkeypatch.setattr(segments, "CHARS_AT_ONCE", at_once)
        asked = []

        def encode(pieces, _, asked=asked):
            asked.extend(pieces)
            return [p.encode("utf-32-le") for p in pieces]

        assert PieceCache(encode).ids(texts) == [(text or "").encode("utf-32-le") for text in texts]
        assert sorted(asked) == sorted(set(want))
