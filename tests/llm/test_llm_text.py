"""Encoding, fingerprints, token files and packing against brute force."""

from __future__ import annotations

import base64
import hashlib
import io
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_fixtures import SF, TEXTS, documents, no_documents, odd_documents  # noqa: F401
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hitloom.llm import bpe, fingerprint, packing, tables, token_files, word_cache
from hitloom.llm.registry import QUERIES


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.tokenizer(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


def ordered(frame):
    return sorted(((r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_perfect_hash_resolves_its_keys_and_no_others():
    keys = [f"key{i}".encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert table.find(keys) == list(range(5000))
    assert sorted(table.index.tolist()) == list(range(5000))
    assert table.find([b"other", b""]) == [-1, -1]
    assert bpe.PerfectHash([]).find([b"x"]) == [-1]


def test_ids_are_those_of_the_library(own, reference):
    rng = random.Random(3)
    made = ["".join(rng.choices(" \n\t.,'abz1éß中🙂_\x1c", k=rng.randint(0, 60))) for _ in range(2000)]
    texts = [t or "" for t in TEXTS] + made
    for text, ids in zip(texts, own.encode_texts(texts), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == reference.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


def test_cache_rotation_changes_nothing(own, reference):
    own.encode_texts.capacity, kept = 3, own.encode_texts.capacity
    texts = [f"some words {i} and {i}." for i in range(50)]
    got = [np.frombuffer(own.encode_texts([t])[0], "<u4").tolist() for t in texts]
    own.encode_texts.capacity = kept
    assert got == [reference.encode_ordinary(t) for t in texts]


def test_op1_query(spark, documents, reference):  # noqa: F811
    got = {r.doc_id: r for r in QUERIES["op1_byte_bpe"](spark, SF).collect()}
    for doc, text in ordered(documents):
        ids = reference.encode_ordinary(text)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_documents_round_trip(odd_documents, no_documents):  # noqa: F811
    rows = bpe.decode_documents(bpe.encode_documents(odd_documents)).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted(
        t.encode() for _, t in ordered(odd_documents))
    assert bpe.decode_documents(bpe.encode_documents(no_documents)).count() == 0


# Fingerprints


def shingles(text, width=fingerprint.WIDTH):
    return {text[i : i + width] for i in range(max(1, len(text) - width + 1))} if text else set()


@pytest.mark.parametrize("width", [1, 3, 5, 8, 11])
def test_hashes_are_as_distinct_as_the_shingles(width):
    for text in TEXTS:
        text = text or ""
        hashes = fingerprint.shingle_hashes(text, width)
        assert len(set(hashes.tolist())) == len(shingles(text, width))


def test_figures_from_fingerprints():
    rng = random.Random(1)
    a = "".join(rng.choices("abcdefgh ", k=6000))
    b = a[:4000] + "".join(rng.choices("abcdefgh ", k=2000))
    x, y = fingerprint.sketch(a), fingerprint.sketch(b)
    both, either = len(shingles(a) & shingles(b)), len(shingles(a) | shingles(b))
    assert abs(fingerprint.resemblance(x, y) - both / either) < 0.15
    assert abs(fingerprint.containment(x, y) - both / len(shingles(a))) < 0.2
    assert abs(fingerprint.distinct_count(x) / len(shingles(a)) - 1) < 0.3
    parts = [fingerprint.sketch(a[i : i + 1000 + fingerprint.WIDTH - 1]) for i in range(0, 6000, 1000)]
    merged = parts[0]
    for part in parts[1:]:
        merged = fingerprint.merge(merged, part)
    assert (merged == x).all()
    assert (fingerprint.from_text(fingerprint.to_text(x)) == x).all()
    assert fingerprint.resemblance(fingerprint.sketch(""), fingerprint.sketch("")) == 1.0
    assert fingerprint.resemblance(x, fingerprint.sketch("")) == 0.0


def check_compared(rows, docs):
    docs = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    left = {}
    for r in rows:
        left.setdefault((r.doc_id, r.edited_sha256), []).append(r)
    for i, (doc, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        edited = fingerprint.edited_text(text, following)
        row = left[doc, hashlib.sha256(edited.encode()).hexdigest()].pop()
        own, next_own = fingerprint.sketch(text), fingerprint.sketch(following)
        assert row.n_chars == len(text)
        assert row.fingerprint == fingerprint.to_text(own)
        assert row.edited_fingerprint == fingerprint.to_text(fingerprint.sketch(edited))
        assert row.near_edited == fingerprint.resemblance(own, fingerprint.sketch(edited))
        assert row.near_next == fingerprint.resemblance(own, next_own)
    assert not any(left.values())


def test_op2_query(spark, documents):  # noqa: F811
    check_compared(QUERIES["op2_bottom_k_fingerprint"](spark, SF).collect(), ordered(documents))


def test_odd_documents_and_their_next(odd_documents, no_documents):  # noqa: F811
    known = odd_documents.where("doc_id IS NOT NULL")
    check_compared(fingerprint.compare_with_next(known).collect(), ordered(known))
    assert fingerprint.compare_with_next(odd_documents).count() == odd_documents.count()
    assert fingerprint.compare_with_next(no_documents).count() == 0
    one = known.where("doc_id = 6").limit(1)
    check_compared(fingerprint.compare_with_next(one).collect(), ordered(one))


def test_fingerprints_merge_by_group(odd_documents, documents):  # noqa: F811
    marks = fingerprint.fingerprint_documents(documents, k=16).join(
        documents.select("doc_id", "lang"), "doc_id")
    merged = fingerprint.merge_fingerprints(marks, "lang", k=16).collect()
    by_lang = {}
    for r in documents.select("lang", "text").collect():
        own = fingerprint.sketch(r.text or "", 16)
        by_lang[r.lang] = fingerprint.merge(by_lang.get(r.lang, own), own, 16)
    assert {r.lang: r.fingerprint for r in merged} == {
        lang: fingerprint.to_text(values) for lang, values in by_lang.items()}


# Token files


def test_op3_query(spark, documents):  # noqa: F811
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    got = {r.doc_id: r for r in QUERIES["op3_token_files"](spark, SF).collect()}
    start = 0
    for doc, text in ordered(documents):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert (got[doc].start, got[doc].n_tokens) == (start, len(ids))
        assert got[doc].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_odd_documents_in_token_files(spark, odd_documents, no_documents):  # noqa: F811
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    folder = token_files.token_file_folder(odd_documents)
    manifest = token_files.write_token_files(odd_documents, folder)
    rows = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    expected = [(doc, [*tokenizer.encode(text, add_special_tokens=False).ids, 1])
                for doc, text in ordered(odd_documents)]
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows] == expected
    folder = token_files.token_file_folder(no_documents)
    manifest = token_files.write_token_files(no_documents, folder)
    assert token_files.read_token_files(manifest, folder).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_reader_unpacks_only_the_frames_asked_for(tmp_path, wide):
    path = str(tmp_path / "x.zst")
    store = fs.LocalFileSystem()
    writer = token_files.TokenFileWriter(store.open_output_stream(path, compression=None), wide,
                                         frame_ids=10)
    docs = {i: np.arange(i, dtype=np.uint32) for i in range(12)} | {None: np.arange(3, dtype=np.uint32)}
    for key, ids in docs.items():
        writer.add(key, ids)
    writer.finish()
    writer.out.close()
    with store.open_input_file(path) as file:
        reader = token_files.TokenFileReader(file)
        unpacked, read = [], reader.frame
        reader.frame = lambda number: unpacked.append(number) or read(number)
        assert {k: v.tolist() for k, v in reader.documents([11, None])} == {
            11: list(range(11)), None: [0, 1, 2]}
        assert len(unpacked) == 2 < len(reader.seek) - 1
        assert {k: v.tolist() for k, v in reader.documents(docs)} == {
            k: v.tolist() for k, v in docs.items()}
    data = bytearray(open(path, "rb").read())
    reader_starts = reader.starts
    data[int(reader_starts[1]) - 6] ^= 1
    (tmp_path / "bad.zst").write_bytes(data)
    with store.open_input_file(str(tmp_path / "bad.zst")) as file, pytest.raises(Exception):
        token_files.TokenFileReader(file).frame(0)


# Packing


def check_packed(rows, docs, most):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for doc, text in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        total += len(ids)
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(ids) // most)))
        assert all(p.length == most for p in pieces[1:])
        at = 0
        for p in pieces:
            part = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert (p.start, p.ids_crc32) == (at, zlib.crc32(part))
            at += p.length
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    return len(by_sequence), -(-total // most)


def test_op6_query(spark, documents):  # noqa: F811
    rows = QUERIES["op6_pattern_packing"](spark, SF).collect()
    used, bound = check_packed(rows, ordered(documents), packing.SEQUENCE)
    assert used <= 1.05 * bound


def test_odd_documents_packed(odd_documents, no_documents):  # noqa: F811
    once = odd_documents.dropDuplicates(["doc_id"])
    check_packed(packing.pack_documents(once, most=16).collect(), ordered(once), 16)
    assert packing.pack_documents(odd_documents).count() == sum(
        r.n for r in packing.document_pieces(odd_documents).groupBy("doc_id").count()
        .withColumnRenamed("count", "n").collect())
    assert packing.pack_documents(no_documents).count() == 0


def test_plan_uses_every_length_up_and_wastes_little():
    rng = np.random.default_rng(0)
    for most, n in ((64, 5000), (1024, 100_000), (1024, 50)):
        lengths = np.minimum(most, 1 + rng.geometric(3 / most, n))
        histogram = np.bincount(lengths, minlength=most + 1)
        plan = packing.pack_histogram(histogram)
        used = np.zeros(most + 1, np.int64)
        for sequence, times in plan:
            assert sum(sequence) <= most and times > 0
            for length in sequence:
                used[length] += times
        assert (used == histogram).all()
        sequences = sum(times for _, times in plan)
        assert sequences <= -(-int(lengths.sum()) // most) * (1.02 if n > 100 else 1.2)
    assert packing.pack_histogram(np.zeros(17, np.int64)) == []


def test_ids_that_do_not_fit_are_refused():
    """They were cut to 16 bits silently."""
    writer = token_files.TokenFileWriter(io.BytesIO())
    with pytest.raises(OverflowError):
        writer.add(1, np.array([70_000, 5], np.uint32))
    out = io.BytesIO()
    wide = token_files.TokenFileWriter(out, wide=True)
    wide.add(1, np.array([70_000, 5], np.uint32))
    wide.finish()
    (_, ids), = token_files.TokenFileReader(out).places(range(1))
    assert ids.tolist() == [70_000, 5]
    assert word_cache.vocabulary_size(public_tokenizers.path("word_bpe_49k.json")) < 65_536


def test_long_chunks_are_encoded_but_not_kept():
    """Texts without blanks are one chunk each; a worker would hold them all."""
    encode = packing._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"{i}" + "xyz" * 30_000 for i in range(20)] + ["a few words, then " + "q" * 500]
    before = len(encode.young)
    got = encode(texts)
    assert max(map(len, encode.young)) <= encode.longest
    assert len(encode.young) < before + 10
    assert got == [encode.encode_whole([text])[0] for text in texts]


def test_words_are_looked_up_once_and_encoded_in_place():
    """Sets of words were gathered, compared and split before anything was encoded."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    path = public_tokenizers.path(packing.VOCABULARY)
    encode = word_cache.library_words(
        path, word_cache.byte_level_chunks, word_cache.byte_level_form)
    asked, one = [], encode.encode
    encode.encode = lambda word: asked.append(word) or one(word)
    texts = ["a word, a word. word", "word) and\nwords", "it's 'tis, don't", "x  y", " z", ""]
    assert encode(texts) == [encode.encode_whole([t])[0] for t in texts]
    assert len(asked) == len(set(asked))
    assert {"a", " word", ",", ".", ")", " and"} <= set(asked) and " word," not in asked
    encode.capacity = 3
    encode.longest = 5
    assert encode(texts * 2) == [encode.encode_whole([t])[0] for t in texts * 2]
    # A letter by itself, in a word, after a blank and before marks, of all of one or two bytes.
    for c in map(chr, range(1, 0x800)):
        texts = [c, f"a{c}{c}b", f"a {c}a {c} a{c}, b"]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)] == want, hex(ord(c))
    assert word_cache.byte_level_form(" Óíñ") == "ĠÃĵÃŃÃ±"


def test_executors_make_batches_of_bounded_bytes(spark):
    """Spark put a task's whole split into one, of up to 64 MB, which its worker held."""

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.get_total_buffer_size()]), pa.array([batch.num_rows])],
                names=["held", "n"])

    def most():
        rows = tables.in_arrow(texts, held, "held bigint, n bigint").collect()
        assert sum(r.n for r in rows) == 300
        return max(r.held for r in rows)

    texts = spark.range(300).coalesce(1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    assert most() < 2 * tables.BATCH_BYTES
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    bounded = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "32m")
        assert most() > 2 * tables.BATCH_BYTES
        assert spark.conf.get(setting) == "32m"
    finally:
        spark.conf.set(setting, bounded)


def test_workers_let_encoders_of_other_stages_go(spark, documents):  # noqa: F811
    """They kept the vocabulary and all cached chunks for as long as they lived."""
    tasks = documents.repartition(8)

    def kept(batches):
        for _ in batches:
            pass
        n = packing._encoder.cache_info().currsize
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    for _ in range(2):
        assert packing.document_pieces(tasks).select("doc_id").distinct().count() == \
            documents.select("doc_id").distinct().count()
        assert {r.n for r in tables.in_arrow(tasks, kept, "n bigint").collect()} == {0}
    own = tables.in_arrow(tasks, kept, "n bigint", keeps=packing._encoder)
    packing.document_pieces(tasks).count()
    assert 1 in {r.n for r in own.collect()}


OUTSIDE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from hitloom.llm import bpe, hard_negatives, main_text, ngram_join, packing, spelling
from pyspark.sql import functions as F
spark = (SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false")
         .config("spark.executor.memory", "1g").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
sys.path.remove({root!r})
docs = spark.createDataFrame([(1, "some words here"), (2, "other words")], "doc_id long, text string")
assert bpe.encode_documents(docs).count() == 2
assert packing.pack_documents(docs).count() == 2
assert spelling.variant_groups(docs).count() == 0
assert ngram_join.ngram_components(docs).count() == 2
print("all found the package")
"""


def test_workers_find_the_package_wherever_it_was_started(tmp_path):
    """Executors that cannot see the repository, and no table read before."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "outside.py"
    script.write_text(OUTSIDE.format(root=root, shared=str(tmp_path / "shared")))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, timeout=300,
                          capture_output=True, text=True)
    assert "all found the package" in done.stdout, done.stderr[-3000:]
