"""The operators as steps over whole ``documents`` tables: what each decides takes effect, all columns stay."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import WORD, slices
from tidelog.llm.language import held_out, learn, predict
from tidelog.llm.line_dedup import dedup_lines
from tidelog.llm.mixing import taken_words
from tidelog.llm.near_dedup import near_classes

#: Least proportion of a document that its main language must have.
MAIN_LANGUAGE = 0.5


def with_text(rows: DataFrame) -> DataFrame:
    """The columns of ``row`` (a struct) with ``text`` put in and ``n_chars``, where there is one, made to fit it."""
    columns = rows.schema["row"].dataType.fieldNames()
    fresh = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return rows.select(*[fresh[c].alias(c) if c in fresh else F.col("row").getField(c).alias(c) for c in columns])


def keep_languages(docs: DataFrame) -> DataFrame:
    """``docs`` without those that have no letter and those in which no language has at least half.

    Learned from the labelled documents of ``docs`` that are not held out; a prediction sees the text alone. Where these
    have no language there is nothing to judge by, and all documents that have a letter stay.
    """
    model = learn(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = predict(docs, model)
    return judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= MAIN_LANGUAGE)).select("row.*")


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies of common lines; a document that loses all its lines stays, empty."""
    return with_text(dedup_lines(docs).select("row", "text"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The document with the smallest ``doc_id`` of every class of near-duplicates; documents without words all stay."""
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc"), key.alias("key"), F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("words"))
    classes = near_classes(docs.select("doc_id", "text"))
    # of a class without any doc_id the text with the smallest hash; its rows alike are one
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = classes.filter("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias("_doc"), F.col("first.key").alias("_key"))
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key"))
    chosen = rows.filter("words").join(first, same, "left_semi").dropDuplicates(["doc", "key"])
    return chosen.select("row.*").unionByName(rows.filter("NOT words").select("row.*"))


def take_mix(docs: DataFrame) -> DataFrame:
    """``docs`` as often as the mix reads them: a row for each whole pass, and one with the words of a pass that the mix cuts short."""
    taken = taken_words(docs.select("doc_id", "source", "text"))
    # rows alike in identifier and text are read together
    taken = taken.groupBy("doc_id", "hash").agg(F.sum("taken").alias("taken"), F.max("size").alias("size")).filter("taken > 0")
    taken = taken.select(F.col("doc_id").alias("_doc"), F.col("hash").alias("_hash"), "taken", "size")
    doc, hashed = F.col("doc_id").cast("bigint"), F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1))
    rows = docs.select(F.struct("*").alias("row"), "text", doc.alias("doc"), hashed.alias("hash"))
    one = rows.withColumn("n", F.row_number().over(Window.partitionBy("doc", "hash").orderBy("hash"))).filter("n = 1")
    joined = one.join(taken, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("hash") == F.col("_hash")))
    joined = joined.select("row", "text", "size", "taken")

    def passes(batches):
        word = re.compile(WORD.encode())
        for batch in batches:
            for part in slices(batch, "text"):
                at, texts = [], []
                for i, (text, size, taken) in enumerate(zip(*(part.column(c).to_pylist() for c in ("text", "size", "taken")), strict=True)):
                    whole, rest = divmod(taken, size)
                    texts += [text] * whole
                    at += [i] * whole
                    if rest:
                        data = text.encode()
                        for n, found in enumerate(word.finditer(data), 1):
                            if n == rest:
                                texts.append(data[: found.end()].decode())
                                at.append(i)
                                break
                yield pa.RecordBatch.from_arrays([part.column("row").take(pa.array(at, pa.int64())), pa.array(texts, pa.string())], names=["row", "text"])

    return with_text(joined.mapInArrow(passes, T.StructType([rows.schema["row"]]).add("text", T.StringType())))
