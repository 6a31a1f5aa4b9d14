"""Token ids: encoder, record files, packing and byte-level BPE against plain loops."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mergewright.llm import byte_bpe, packing, records, tokens

ODD = ["", "a", "a  b", "a   b", "a\n\nb", "a\n\n\nb", "a \n b", "x'sam it's we're 'tis", "end  ", "end\n\n", " lead", "\n lead",
       "a\tb\t c", "a\t \tb", "é ü\xa0 \n x", "<|endoftext|> hi", "a\0b c", "日本語 テキスト", "!!! ,,, a,b c.d e.. f$, 12th 3.14",
       None, "a²b x² Ⅷ", "\x85 x", " ", "  ", "\n", "a" * 3000, "word, word. Word! wörd, Ġ Ċ"]


@pytest.fixture(scope="module")
def plain():
    return tokens.Encoder(tokens.definition())


def ids_by_id(plain, df):
    rows = df.select("doc_id", "text").collect()
    return [(r.doc_id, r.text or "", plain._encode_whole([r.text or ""])[0].astype("<u4")) for r in rows]


def test_encoder_equals_whole_texts(plain):
    expected = [e.tolist() for e in plain._encode_whole([t or "" for t in ODD])]
    encoder = tokens.Encoder(tokens.definition(), keep=5)
    for _ in range(2):  # the second time with some parts known and some forgotten
        assert [e.tolist() for e in encoder.encode(pa.array(ODD))] == expected
    assert len(encoder.index) < 200


def test_ids_are_those_of_a_fresh_tokenizer(spark):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokens.default_path())
    added = [f"{a}<|endoftext|>{b}" for a in ("", "hello ", "word", "a\n") for b in ("", " world", "word", "\nb", "<|endoftext|>")]
    texts = [t or "" for t in [*ODD, *added, "<|endoftext |>", "endoftext"]]
    expected = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[texts.index("hello <|endoftext|> world")] == [31373, 220, 50256, 995]
    assert [e.tolist() for e in tokens.Encoder(tokens.definition()).encode(pa.array(texts))] == expected
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = records.write_records(docs, end_id=0)
    start = 0
    for row in sorted(records.read_records(spark, written).collect(), key=lambda r: r.doc_id):
        assert (row.start, np.frombuffer(row.ids, "<u4").tolist()) == (start, [*expected[row.doc_id], 0])
        start += row.n_tokens


def test_frames_round_trip_and_break():
    payloads = [records.serialise(None, np.array([], np.uint32)), records.serialise(7, np.array([1, 70000], np.uint32))]
    data = b"".join(map(records.frame, payloads))
    assert list(records.unframe(io.BytesIO(data), "f")) == payloads
    assert records.parse(payloads[1])[1].tolist() == [1, 70000] and records.parse(payloads[0])[0] is None
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(io.BytesIO(bytes(broken)), "f"))
    with pytest.raises(ValueError):
        list(records.unframe(io.BytesIO(data[:-1]), "f"))


def test_records_are_read_back_in_order(spark, edge, none, plain):
    written = records.write_records(edge, end_id=0, file_bytes=500)
    got = sorted(records.read_records(spark, written).collect(), key=lambda r: r.start)
    expected = sorted(ids_by_id(plain, edge), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start = 0
    assert len(got) == len(expected)
    for row, (doc_id, _, ids) in zip(got, expected, strict=True):
        assert (row.doc_id, row.start, bytes(row.ids)) == (doc_id, start, np.append(ids, 0).astype("<u4").tobytes())
        start += row.n_tokens
    index = records.read_index(spark, written)
    assert index.select("file").distinct().count() > 3
    assert index.filter("length > 500 and offset > 0").count() == 0
    assert records.read_records(spark, records.write_records(none)).count() == 0


def test_room_tree_finds_the_tightest_window():
    random.seed(3)
    tree, kept = packing.RoomTree(64), []
    for step in range(2000):
        if random.random() < 0.5:
            room = random.randint(1, 64)
            tree.add(room, step)
            kept.append(room)
        else:
            need = random.randint(1, 64)
            fits = [r for r in kept if r >= need]
            found = tree.take(need)
            assert (found[0] if found else None) == min(fits, default=None)
            if found:
                kept.remove(found[0])


def test_best_fit_equals_a_plain_search():
    random.seed(4)
    lengths = [random.randint(1, 100) for _ in range(300)]
    room = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in room if r >= n), default=None)
        if fit is None:
            room.append(100 - n)
        else:
            room.remove(fit)
            room.append(fit - n)
    windows = packing.best_fit(lengths, 100)
    assert sorted(100 - sum(lengths[i] for i in w) for w in windows) == sorted(room)
    assert sorted(i for w in windows for i in w) == list(range(300))


def test_pieces_cover_every_id_once(spark, edge, none, plain):
    for blocks in ({}, {"block_tokens": 50, "block_pieces": 3}):
        rows = packing.pieces(packing.pack(edge, window=64, **blocks)).collect()
        texts = {}
        for doc_id, text, ids in ids_by_id(plain, edge):
            texts.setdefault(doc_id, []).append(np.append(ids, 1).astype("<u4"))
        covered = {}
        for r in rows:
            assert any(len(t) == r.doc_tokens and zlib.crc32(t[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                       for t in texts[r.doc_id])
            covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
        assert covered == {k: sum(map(len, v)) for k, v in texts.items()}
        by_sequence = {}
        for r in rows:
            by_sequence.setdefault(r.sequence_id, []).append(r)
        for placed in by_sequence.values():
            placed.sort(key=lambda r: r.offset)
            filled = 0
            for r in placed:
                assert r.offset == filled
                filled += r.length
            assert filled <= 64 and placed[0].padded_length == (filled if filled & (filled - 1) == 0 else 64)
    assert packing.pack(none).count() == 0


def test_chunked_encoding_equals_whole(spark, edge, none):
    coder = byte_bpe.Coder(*byte_bpe.read_ranks())
    more = edge.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(100 + i, t) for i, t in enumerate(ODD)] + [(200, "a" * 700), (201, " " * 500 + "x"),
                                                     (202, "it's   we're\n\n\n  ok " * 60), (203, "é ü\t日本 " * 90)],
        "doc_id long, text string"))
    expected = sorted((r.doc_id or -1, coder.encode(r.text or ""), (r.text or "").encode()) for r in more.collect())
    for chunk, overlap in ((100, 40), (1 << 16, 1 << 11)):
        got = byte_bpe.decode(byte_bpe.encode(more, chunk=chunk, overlap=overlap)).collect()
        assert sorted((r.doc_id or -1, bytes(r.ids), bytes(r.bytes)) for r in got) == expected
        assert all(r.n_tokens * 4 == len(r.ids) for r in got)
        one_pass = byte_bpe.encode(more, chunk=chunk, overlap=overlap, decoded=True).collect()
        assert sorted((r.doc_id or -1, bytes(r.ids), bytes(r.bytes)) for r in one_pass) == expected
    assert byte_bpe.decode(byte_bpe.encode(none)).count() == 0


def test_seams_fall_into_step_at_pre_tokens():
    import public_tokenizers
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    text = "The quick 'brown' fox's  den,\n\n and 12 more " * 20
    true = {m.start() for m in pattern.finditer(text)}
    parts = byte_bpe.cut(text, 100, 40)
    for (start, part), (after, following) in zip(parts, parts[1:], strict=False):
        _, tail = byte_bpe.ends_of(pattern, part, start == 0, False, 100, 40)
        head, _ = byte_bpe.ends_of(pattern, following, False, after == parts[-1][0], 100, 40)
        assert min(set(head) & set(tail)) + after in true
