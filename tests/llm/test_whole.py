"""Cases in which operators once did less than the whole job."""

import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from tidelog.llm import packing, stages, warc  # noqa: E402
from tidelog.llm.language import has_letter  # noqa: E402
from tidelog.llm.queries import ORACLE, QUERIES  # noqa: E402


def test_added_tokens(spark, tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pick = random.Random(5)
    bits = ["<|endoftext|>", " ", "\n", "hello", " world", "<|", "endoftext", "|>", "don't", "  ", "\u00e9", "12", "\U0001f600"]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|>" * 3, "<|endoftext|" + "x" * 9]
    texts += ["".join(pick.choices(bits, k=pick.randrange(1, 12))) for _ in range(300)]
    encode = packing.encoder(packing.vocabulary_path()).encode
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert wanted[0] == [31373, 220, 50256, 995]
    assert [encode(t, allowed_special="all") for t in texts] == wanted
    docs = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = QUERIES["op5_packing"](spark, tables(documents=docs)).collect()
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in got) == [(i, len(w) + 1, zlib.crc32(np.array([*w, 0], "<u4").tobytes())) for i, w in enumerate(wanted)]


def test_pipeline_gives_sequences(spark, prose):
    # read three times, once cut short, as after mixing; one text is longer than a sequence
    texts = [prose(300, 1), prose(300, 1), prose(300, 1)[:200], prose(4_000, 2), "", None, "a <|endoftext|> b"]
    docs = spark.createDataFrame([(i // 3, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = corpus_pipeline.packing(spark, docs, "").collect()
    assert "ids" in got[0].asDict()
    encode = packing.encoder(packing.vocabulary_path()).encode
    sequences, wanted = {}, Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        own = sequences.setdefault(r.sequence_id, [])
        assert r.offset == len(own) and r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        own += r.ids
    for i, t in enumerate(texts):
        ids = [*encode(t or "", allowed_special="all"), 0]
        wanted.update((i // 3, n, tuple(ids[a : a + size])) for n, (a, size) in enumerate(packing.cut(len(ids))))
    assert Counter((r.doc_id, r.piece, tuple(sequences[r.sequence_id][r.offset : r.offset + r.length])) for r in got) == wanted
    assert max(map(len, sequences.values())) <= 2048


def test_run_gives_texts(spark, tables):
    rows = [(i, f"The {w} of the house and the garden was in a book {i} " * 4, "en", "s", 0) for i, w in enumerate(["cat", "dog", "cow", "hen", "fox", "owl"])]
    decode = packing.encoder(packing.vocabulary_path()).decode
    got = corpus_pipeline.run(spark, tables(documents=rows)).collect()
    assert got and all(rows[r.doc_id][1].startswith(decode(r.ids[:-1])) and r.ids[-1] == packing.END_ID for r in got)


def test_no_label_drops_nothing(spark, prose):
    texts = [prose(30, 1), "é", "\U0001d4d0 ①", "日本", "ª", "12 34", "² ½ _ ①", "", None]
    wanted = sorted(i for i, t in enumerate(texts) if has_letter(t or ""))
    ddl = "doc_id bigint, text string, lang string"
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], ddl)
    assert sorted(r.doc_id for r in stages.keep_languages(docs).collect()) == wanted and len(wanted) == 5
    # labelled, but all held out of learning
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, prose(20, i), "en") for i in held], ddl)
    kept = stages.keep_languages(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == held


def test_addresses_that_end_in_the_mark(spark, tables, same_as_sql):
    urls = ["http://a.org/WARC/1.1", "WARC/1.1", "http://b.org/WARC/1.1/x", "http://c.org/WARC/1.1\r\n", "http://d.org/WARC/1.1"]
    pages = [(i, u, t) for i, (u, t) in enumerate(zip(urls, ["<p>a</p>", "é" * 40_000, "b", "c", "<p>a</p>"], strict=True))]
    folder = tables(pages=pages)
    same_as_sql(QUERIES["op1_warc_reassembly"](spark, folder), ORACLE["op1_warc_reassembly"], folder)


def test_damage_is_an_error(spark, tables, monkeypatch):
    read = warc.read_payloads
    monkeypatch.setattr(warc, "read_payloads", lambda *a: read(*a).withColumn("whole", F.lit(False)))
    with pytest.raises(Exception, match="not read back whole"):
        QUERIES["op1_warc_reassembly"](spark, tables(pages=[(1, "u", "<p>a</p>")])).collect()
