"""WARC archives, token files and packing: round trips."""
import hashlib
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearfill.llm import blobs, encoding, packing, token_files, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "Hello World's  end\n\n next", "a\tb\r\nc", "<|endoftext|> x", "日本語 é ́x 12345", "word " * 2500, "same", "same", "\x00 a"]


# ---------------------------------------------------------------- tokens
@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_give_the_ids_of_whole_texts(path):
    texts = [t or "" for t in TEXTS] * 2
    enc = encoding.Encoder(path)
    want = [e.ids for e in encoding.tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts)] == want
    assert [x.tolist() for x in enc.encode(texts)] == want


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab 'sS\n\t1é .!  ", max_size=30))
def test_pieces_of_any_text(text):
    for path in (WORDS, BYTES):
        enc = encoding.encoder(path)
        assert next(enc.encode([text])).tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(encoding, "CACHE_PIECES", 3)
    monkeypatch.setattr(encoding.textbytes.slices, "__defaults__", (10,))
    texts = [f"x{i} y{i % 5} z" for i in range(60)]
    enc = encoding.Encoder(BYTES)
    want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts)] == want and enc.known <= 20


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_bits_round_trip(bits, ids):
    ids = np.array([i % (1 << bits) for i in ids], dtype=np.uint32)
    assert (token_files.unpack_bits(token_files.pack_bits(ids, bits), bits, len(ids)) == ids).all()


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 50)
    rows = list(enumerate(TEXTS)) + [(None, "null key"), (7, "same"), (-3, "minus")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, uri string")
    files = token_files.write(docs, WORDS, end_id=2)
    got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in token_files.read(files).orderBy("start").collect()]
    tok, want, at = encoding.tokenizer(WORDS), [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, at, len(ids), ids.tobytes()))
        at += len(ids)
    assert got == want
    whole = np.frombuffer(b"".join(w[3] for w in want), "<u4")
    for f in files.collect():
        part = whole[f.first_id:f.first_id + f.n_ids]
        assert (token_files.read_ids(f.uri, 3, 20) == part[3:23]).all() and len(token_files.read_ids(f.uri, f.n_ids, 5)) == 0
    assert token_files.read(token_files.write(docs.where("false"), WORDS, end_id=2)).count() == 0


def test_random_access_reads_across_blocks(tmp_path):
    ids = np.random.default_rng(0).integers(0, 49408, 20_000).astype(np.uint32)
    uri = blobs.write(str(tmp_path), "t", token_files.file_parts([1, None], [15_000, 5_000], ids, 16))
    assert (token_files.read_ids(uri, 4090, 9000) == ids[4090:13090]).all()
    keys, lengths, back = token_files.parse(blobs.read(uri))
    assert keys == [1, None] and lengths.tolist() == [15_000, 5_000] and (back == ids).all()
    assert os.path.getsize(blobs._open(uri)[1]) < 2 * len(ids) + 1000


# ---------------------------------------------------------------- packing
@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing_is_the_plain_one(lengths):
    window, offset = packing.best_fit_decreasing(np.array(lengths, dtype=np.int64), 20)
    rooms, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms[rooms.index(min(fits))] -= lengths[i]
        else:
            rooms.append(20 - lengths[i])
    used: dict = {}
    for w, o, n in sorted(zip(window.tolist(), offset.tolist(), lengths)):
        assert used.get(w, 0) == o
        used[w] = o + n
    assert sorted(20 - u for u in used.values()) == sorted(rooms)


def test_pieces_cover_every_document(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_IDS", 500)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "null", 0), (3, "a\tb\r\nc", 0)],
                                 "doc_id long, text string, start int")
    pieces = packing.pack(docs, BYTES, end_id=1).collect()
    tok = encoding.tokenizer(BYTES)
    found: dict = {}
    for p in pieces:
        assert p.length * 4 == len(p.ids) <= 4 * packing.CAPACITY
        found.setdefault(p.doc_id, []).append((p.start, bytes(p.ids), p.doc_tokens))
    for i, t in enumerate(TEXTS):
        if i != 3:
            want = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
            assert b"".join(x[1] for x in sorted(found[i])) == want.tobytes() and {x[2] for x in found[i]} == {len(want)}
    assert len(found[3]) == 2 and len(found[None]) == 1
    fill: dict = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert fill.get(p.sequence_id, 0) == p.offset
        fill[p.sequence_id] = p.offset + p.length
    assert max(fill.values()) <= packing.CAPACITY
    assert packing.pack(docs.where("false"), BYTES, end_id=1).count() == 0


# ---------------------------------------------------------------- WARC
def pages(spark):
    big, other = "<p>" + "x" * 1200, "<p>" + "é" * 500
    rows = [(i, f"http://h/{i}", big) for i in (4, 9, 2)] + [(5, None, other), (6, "u", other), (7, "u", "small"), (8, "u", "small"),
                                                            (10, "u", None), (11, "u", ""), (9, "again", big), (None, "u", big)]
    rows += [(100 + i, "http://h/p", f"<html><body>{'lorem ipsum ' * 200}{i}</body></html>") for i in range(200)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_archives_round_trip(spark):
    rows, df = pages(spark)
    archives = warc.write(df.repartition(2))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(archives).collect()]
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        top = max((k for k, _, h in rows if (h or "").encode() == data and k is not None), default=None)
        revisit = len(data) >= 1000 and i != top
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    assert sorted(got, key=str) == sorted(want, key=str)
    texts = {r.page_id: bytes(r.payload).decode() for r in warc.read(archives, with_payload=True).where("record_type = 'response'").collect()}
    assert texts[9] == rows[0][2] and texts[10] == "" and texts[150] == rows[[r[0] for r in rows].index(150)][2]
    assert warc.read(warc.write(df.where("false"))).count() == 0


def test_the_dictionary_is_in_a_leading_skippable_frame():
    records = [warc.record(i, "u", (f"<html>{'shared text of every page ' * 20}{i * 7919}</html>" * 3).encode(), "d", 9, None) for i in range(300)]
    data = b"".join(warc.archive(records))
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little") and int.from_bytes(data[4:8], "little") > 1000
    assert list(warc.records_of(data)) == records
    assert len(data) < sum(len(zlib.compress(r)) for r in records)
    for few in (records[:1], records[:2], [records[0]] * 5, [b"WARC/1.1 " + bytes(range(256))]):
        data = b"".join(warc.archive(few))
        assert int.from_bytes(data[4:8], "little") > 200 and list(warc.records_of(data)) == few


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_that_collide_modulo_powers_of_two_keep_their_ids(path):
    enc, tok = encoding.Encoder(path), encoding.tokenizer(path)
    texts = [f"x {w} y" for n in (512, 1024, 2048, 4096, 8192) for w in thue_morse(n)]
    for text, ids in zip(texts, enc.encode(texts)):
        assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids


def test_padding_does_not_depend_on_the_partitions(spark):
    rows = [(i, " ".join(f"w{i * 7 % 97}" for _ in range(20 + i * 37 % 900))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 32, 200):
        pieces = packing.pack(docs.repartition(parts), BYTES, end_id=1).toPandas()
        assert pieces.length.sum() > 0.98 * packing.CAPACITY * pieces.sequence_id.nunique()
