"""Segment names, routing labels, object paths and small option texts, as column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schema import OFFSET_PAD_WIDTH


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def padded_offset(offset, pad: int = OFFSET_PAD_WIDTH) -> Column:
    """Zero-padded offset text; wider offsets keep all their digits."""
    text = _col(offset).cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(pad) - F.length(text), F.lit(0))), text)


def segment_name(topic, partition, first_offset, generation=None, pad: int = OFFSET_PAD_WIDTH) -> Column:
    """``topic/[generation/]partition/topic-partition-<offset>.avro``."""
    topic, partition = _col(topic), _col(partition).cast("string")
    folder = [topic, partition] if generation is None else [topic, _col(generation), partition]
    leaf = F.concat(F.concat_ws("-", topic, partition, padded_offset(first_offset, pad)), F.lit(".avro"))
    return F.concat_ws("/", *folder, leaf)


def route(topic="topic", partition="partition") -> Column:
    """Routing label of a record."""
    return F.concat(F.lit("topic="), _col(topic), F.lit(";partition="), _col(partition).cast("string"))


def policy_scope(topic, generation=None) -> Column:
    """Object prefix a retention rule covers; the closing slash keeps ``a`` apart from ``ab``."""
    topic = _col(topic)
    if generation is None:
        return F.concat(topic, F.lit("/"))
    generation = _col(generation)
    return F.concat(topic, F.lit("/"), F.coalesce(F.concat(generation, F.lit("/")), F.lit("")))


def parse_segment_path(df: DataFrame, path: str = "path") -> DataFrame:
    """Add topic, generation, partition and first_offset read from a segment name.

    The last folder is the partition. The file name repeats topic and partition, which tells
    where the topic starts when the path has leading folders of the store.
    """
    parts = F.split(F.col(path), "/")
    leaf = F.element_at(parts, -1)
    pattern = r"^(.*)-(\d+)-(\d+)\.[^.]+$"
    topic = F.regexp_extract(leaf, pattern, 1)
    third = F.try_element_at(parts, F.lit(-3))
    return df.withColumns(
        {
            "topic": F.nullif(topic, F.lit("")),
            "generation": F.when(third != topic, third),
            "partition": F.regexp_extract(leaf, pattern, 2).try_cast("int"),
            "first_offset": F.regexp_extract(leaf, pattern, 3).try_cast("bigint"),
        }
    )


def parse_topic_pair(text) -> Column:
    """``old:new`` to a struct; a single name stands for both sides."""
    parts = F.transform(F.split(_col(text), ":"), F.trim)
    old = F.get(parts, F.lit(0))
    return F.struct(
        old.alias("source_topic"), F.coalesce(F.get(parts, F.lit(1)), old).alias("target_topic")
    )


def parse_topic_map(text: str) -> dict[str, list[str]]:
    """Option text ``a:b,c,a:d`` to ``{"a": ["b", "d"], "c": ["c"]}``. A topic may have several targets."""
    targets: dict[str, list[str]] = {}
    for item in filter(str.strip, text.split(",")):
        source, _, target = item.partition(":")
        names = targets.setdefault(source.strip(), [])
        if (name := target.strip() or source.strip()) not in names:
            names.append(name)
    return targets


def target_topics(topic, targets: dict[str, list[str]]) -> Column:
    """Array of the target names of a topic; its own name, if it has none."""
    own = F.array(_col(topic))
    if not targets:
        return own
    lookup = F.create_map(*[c for s, t in targets.items() for c in (F.lit(s), F.array(*map(F.lit, t)))])
    return F.coalesce(F.try_element_at(lookup, _col(topic)), own)


def parse_offset_spec(df: DataFrame, spec: str = "spec") -> DataFrame:
    """Rows (partition, committed) from texts such as ``0:10,1:100``; all other columns are kept.

    The last entry of a repeated partition wins. An entry without a colon fails the query.
    """
    keep = [F.col(c) for c in df.columns if c != spec]
    entries = df.select(*keep, F.posexplode(F.split(F.col(spec), ",")).alias("_pos", "_entry"))
    pair = F.split(F.trim(F.col("_entry")), ":")
    checked = F.when(F.size(pair) == 2, F.get(pair, F.lit(1))).otherwise(
        F.raise_error(F.concat(F.lit("expected partition:offset, got "), F.col("_entry"))).cast("string")
    )
    named = [c for c in df.columns if c != spec]
    return (
        entries.withColumns(
            {"partition": F.get(pair, F.lit(0)).cast("int"), "committed": checked.cast("bigint")}
        )
        .groupBy(*named, "partition")
        .agg(F.max_by("committed", "_pos").alias("committed"))
    )
