"""Schemas that drift between files (problem 6).

Every file of a feed is profiled: for each JSON path its type, how many values lie in the range of each field, and a value
sketch (for each of 16 hash buckets of stations, the value of the station with the least hash). All paths of a file are
matched to those of the file before by a maximum-weight bipartite matching, whose weights hold the likeness of names and
types and the agreement of the sketches; all pairs of files are matched side by side. The links are followed along the feed,
in chunks that are composed, so that each path belongs to one chain through all versions. A chain is labelled once, from
all its names and ranges, and where no name tells, from its values at stations whose fields are known. The labelled chains
give one table and the changes of each file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType, StructType

from rainloom.functions import matching
from rainloom.sources.tables import staged

FIELDS = tuple(matching.ALIASES)
KINDS = ("array", "boolean", "number", "string")
BUCKETS = 16
#: Values in a sketch from here on stand for texts; no field has values as large.
TEXT_VALUES = 1e7
LEAST_WEIGHT = 0.7
#: Weight of the agreement of values; names and types weigh at most 1 and 0.2.
VALUES_WEIGHT, TYPE_WEIGHT = 1.5, 0.2
#: Weight of a chain that only its values tell of; less than that of a name, which comes first where both stand in one file.
UNNAMED_WEIGHT = 0.9
#: Files of a feed that one task follows at once; chunks are composed afterwards.
CHUNK_FILES = 256
FOOT_M = 0.3048
_NUMBER = r"""^\s*([+-]?[0-9]+\.?[0-9]*|[+-]?\.[0-9]+)\s*(?:[°d]\s*)?(?:([0-9.]+)\s*['′]\s*)?(?:([0-9.]+)\s*["″]\s*)?([NSEWOnsewo]|m|ft|feet)?\.?\s*$"""
FILE = ["feed", "file_seq"]


def _opened(level: DataFrame) -> DataFrame:
    """`level` with each object in `leaf` replaced by one row per key; `type` is that of the leaf, so that only objects are opened."""
    children = F.when(F.col("type").startswith("OBJECT"), F.try_variant_get("leaf", "$", "map<string,variant>"))
    rest = [c for c in level.columns if c not in ("path", "leaf", "type")]
    rows = level.select(*rest, *[F.col(c).alias(f"_{c}") for c in ("path", "leaf", "type")], F.explode_outer(children).alias("_k", "_v"))
    kept = F.col("_k").isNull()
    return rows.select(*rest, F.when(kept, F.col("_path")).otherwise(F.concat_ws(".", "_path", "_k")).alias("path"), F.when(kept, F.col("_leaf")).otherwise(F.col("_v")).alias("leaf"), F.when(kept, F.col("_type")).otherwise(F.schema_of_variant("_v")).alias("type"))


def leaves(catalog: DataFrame) -> DataFrame:
    """(record_id, feed, file_seq, station, path, kind, value, text): the non-null leaves of each payload down to three levels, in one pass.

    `kind` is number, string, array or boolean; of an array the first element gives the value. Payloads that are null or no JSON object have no leaves.
    """
    doc = catalog.select("record_id", "feed", "file_seq", F.try_parse_json("payload").alias("leaf"), F.lit(None).cast("string").alias("path"), "payload")
    # only the outermost brackets tell that a record is an object
    outermost = F.when(F.ltrim("payload").startswith("{"), "OBJECT").otherwise("")
    top = doc.withColumn("type", outermost).withColumn("station", F.try_variant_get("leaf", "$.station", "string"))
    flat = _opened(_opened(_opened(top.drop("payload")))).filter("path is not null and type <> 'VOID' and not startswith(type, 'OBJECT')")
    kind = F.when(F.col("type").startswith("ARRAY"), "array").when(F.col("type") == "STRING", "string").when(F.col("type") == "BOOLEAN", "boolean").otherwise("number")
    text = F.when(F.col("kind") == "array", F.try_variant_get("leaf", "$[0]", "string")).otherwise(F.try_variant_get("leaf", "$", "string"))
    plain = F.try_variant_get("leaf", "$", "double")
    feet = F.lower("path").rlike("(ft|feet)$")
    value = F.when(F.col("kind") == "number", F.when(feet, plain * FOOT_M).otherwise(plain)).otherwise(number(F.col("text"), F.col("path")))
    return flat.withColumn("kind", kind).withColumn("text", text).select("record_id", *FILE, "station", "path", "kind", value.alias("value"), "text")


def number(text: Column, path: Column) -> Column:
    """Degrees or metres of a text such as `12.5`, `12.5 W`, `12°30.5'S`, `410 ft`; null where it holds none. A path that ends in ft holds feet."""
    part = lambda i: F.regexp_extract(text, _NUMBER, i)
    size = F.coalesce(part(2).try_cast("double"), F.lit(0.0)) / 60 + F.coalesce(part(3).try_cast("double"), F.lit(0.0)) / 3600
    whole = part(1).try_cast("double")
    side, sign = F.upper(part(4)), F.when(part(1).startswith("-"), -1.0).otherwise(1.0)
    value = (F.abs(whole) + size) * sign * F.when(side.isin("S", "W", "O"), -1.0).otherwise(1.0)
    feet = side.isin("FT", "FEET") | ((side != "M") & F.lower(path).rlike("(ft|feet)$"))
    return F.when(feet, value * FOOT_M).otherwise(value)


def profiles(parts: DataFrame) -> DataFrame:
    """(feed, file_seq, paths): one row per file, with the profile of each of its paths. Values are counted before the rows of a file meet.

    A sketch is two arrays: hashes of stations, and the value of each; a text without a number has a value above TEXT_VALUES by its hash.
    """
    value = F.coalesce("value", F.lit(TEXT_VALUES) + F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
    counted = (
        parts.withColumn("h", F.xxhash64("station"))
        .groupBy(*FILE, "path", F.pmod("h", F.lit(BUCKETS)).alias("bucket"))
        .agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS], F.count("value").alias("numeric"), *[F.count_if(F.col("value").between(*matching.RANGES[f])).alias(f) for f in FIELDS], F.min("h").alias("h"), F.min_by(value, "h").alias("v"))
    )
    together = counted.repartition(*FILE)  # the groups below are already together
    per_path = together.groupBy(*FILE, "path").agg(*[F.sum(c).alias(c) for c in (*KINDS, "numeric", *FIELDS)], F.collect_list("h").alias("h"), F.collect_list("v").alias("v"))
    kind = F.array_max(F.array(*[F.struct(F.col(k).alias("n"), F.lit(k).alias("kind")) for k in KINDS]))["kind"]
    n = sum((F.col(k) for k in KINDS[1:]), F.col(KINDS[0]))
    return per_path.groupBy(*FILE).agg(F.sort_array(F.collect_list(F.struct("path", kind.alias("kind"), n.alias("n"), "numeric", *FIELDS, "h", "v"))).alias("paths"))


def _agreement(a: dict, b: dict) -> float | None:
    """The share of stations with equal values among those in both sketches; None where there are none."""
    theirs = a["sketch"]
    common = [(theirs[h], v) for h, v in b["sketch"].items() if h in theirs]
    return sum(abs(x - y) <= 0.5 + min(10.0, 1e-3 * abs(x)) for x, y in common) / len(common) if common else None


def _links(before: list[dict], now: list[dict]) -> dict[str, str]:
    """The path before of each path now that goes on from it."""
    known = {p["path"]: p for p in before}
    out: dict[str, str] = {}
    for p in now:
        if (q := known.get(p["path"])) is not None and (_agreement(q, p) or 0.0) >= 0.5:
            out[p["path"]] = q["path"]
    left, right = [q for q in before if q["path"] not in out], [p for p in now if p["path"] not in out]
    if not left or not right:
        return out
    weights = []
    for q in left:
        row = []
        for p in right:
            name, agreed = matching.resemblance(q["path"], p["path"]), _agreement(q, p)
            w = name + VALUES_WEIGHT * (agreed or 0.0)
            row.append(w + TYPE_WEIGHT * (p["kind"] == q["kind"]) if w >= LEAST_WEIGHT else 0.0)
        weights.append(row + [0.0] * len(left))
    for q, row, j in zip(left, weights, matching.assign(weights)):
        if row[j] > 0:
            out[right[j]["path"]] = q["path"]
    return out


def linked(files: DataFrame) -> DataFrame:
    """(feed, file_seq, rank, columns): for each path of a file the path of the file before from which it goes on. All pairs of files are matched side by side."""
    order = Window.partitionBy("feed").orderBy("file_seq")  # keys only
    keys = files.select(*FILE).withColumns({"rank": F.row_number().over(order) - 1, "prev": F.lag("file_seq").over(order)})
    earlier = files.select("feed", F.col("file_seq").alias("prev"), F.col("paths").alias("before"))
    arrays = lambda p: [F.col(f"{p}.{c}").alias(f"{p}_{c}") for c in ("path", "kind", "h", "v")]
    pairs = keys.join(files, FILE).join(earlier, ["feed", "prev"], "left").select(*FILE, "rank", *arrays("paths"), *arrays("before"))
    schema = StructType([pairs.schema["feed"], pairs.schema["file_seq"], pairs.schema["rank"]]).add(StructType.fromDDL("columns array<struct<path:string,kind:string,prev:string>>").fields[0])

    def columns(batch: pa.RecordBatch, of: str) -> Iterator[list[dict]]:
        for row in zip(*(batch.column(f"{of}_{c}").to_pylist() for c in ("path", "kind", "h", "v"))):
            yield [{"path": p, "kind": k, "sketch": dict(zip(h, v))} for p, k, h, v in zip(*row)] if row[0] else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        for batch in batches:
            out = []
            for now, before in zip(columns(batch, "paths"), columns(batch, "before")):
                prev = _links(before, now)
                out.append([{"path": p["path"], "kind": p["kind"], "prev": prev.get(p["path"])} for p in now])
            result = to_arrow_schema(schema)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*FILE, "rank")), pa.array(out, result.field("columns").type)], schema=result)

    return pairs.mapInArrow(run, schema)


def _follow(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each path of the files of a chunk, which come in order: the path that enters the chunk and leads to it, or where its chain begins."""
    chunk, state = None, {}
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            fresh = (r["feed"], r["chunk"]) != chunk
            chunk, new = (r["feed"], r["chunk"]), {}
            for c in r["columns"]:
                if c["prev"] is None:
                    new[c["path"]] = None, f"{r['rank']}:{c['path']}"
                else:
                    new[c["path"]] = (c["prev"], None) if fresh else state[c["prev"]]
                enters, born = new[c["path"]]
                out.append({**{k: r[k] for k in (*FILE, "rank", "chunk")}, "path": c["path"], "kind": c["kind"], "enters": enters, "born": born})
            state = new
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _compose(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The chain of each path that enters a chunk, from the last paths of the chunks before, which come in order."""
    feed, state = None, {}
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["feed"] != feed:
                feed, state = r["feed"], {}
            state = {c["path"]: c["born"] if c["enters"] is None else state[c["enters"]] for c in r["last"]}
            out += [{"feed": feed, "chunk": r["chunk"] + 1, "enters": p, "chain": x} for p, x in state.items()]
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def chained(links: DataFrame) -> DataFrame:
    """(feed, file_seq, rank, path, kind, chain): the chain of versions to which each path belongs."""
    from pyspark.sql.pandas.types import to_arrow_schema

    strings = lambda s, *names: StructType([*s.fields, *[StructType().add(n, StringType()).fields[0] for n in names]])
    cut = links.withColumn("chunk", F.floor(F.col("rank") / CHUNK_FILES).cast("int"))
    nodes_schema = strings(StructType([cut.schema[c] for c in (*FILE, "rank", "chunk")]), "path", "kind", "enters", "born")
    run = lambda b: _follow(b, to_arrow_schema(nodes_schema))
    nodes = staged(cut.repartition("feed", "chunk").sortWithinPartitions("feed", "chunk", "rank").mapInArrow(run, nodes_schema))
    ends = nodes.filter(F.col("rank") % CHUNK_FILES == CHUNK_FILES - 1).groupBy("feed", "chunk").agg(F.collect_list(F.struct("path", "enters", "born")).alias("last"))
    entered_schema = strings(StructType([cut.schema[c] for c in ("feed", "chunk")]), "enters", "chain")
    run = lambda b: _compose(b, to_arrow_schema(entered_schema))
    # one row per CHUNK_FILES files of a feed
    entered = ends.repartition("feed").sortWithinPartitions("feed", "chunk").mapInArrow(run, entered_schema)
    return nodes.join(entered, ["feed", "chunk", "enters"], "left").select(*FILE, "rank", "path", "kind", F.coalesce("chain", "born").alias("chain"))


def _named(paths: Column) -> Column:
    """How much the best of the names of a chain is like each field."""
    likeness = F.pandas_udf(lambda s: s.map(lambda xs: [max((matching.likeness(f, x) for x in xs), default=0.0) for f in FIELDS]), "array<double>")
    return likeness(paths)


def labelled(files: DataFrame, nodes: DataFrame) -> DataFrame:
    """(feed, chain, weights): how well each chain stands for each field, from all its names, its values and its sketches.

    Most values must be numbers in the range of the field. Chains without a telling name are held against the values that the
    named chains of all feeds have at the same stations.
    """
    key = ["feed", "chain"]
    columns = nodes.join(files.select(*FILE, F.inline("paths")).drop("kind"), [*FILE, "path"])
    sums = columns.groupBy(*key).agg(F.collect_set("path").alias("names"), *[F.sum(c).alias(c) for c in ("n", "numeric", *FIELDS)])
    able = F.array(*[(F.col("numeric") * 2 > F.col("n")) & (F.col(f) * 2 > F.col("numeric")) for f in FIELDS])
    chains = staged(sums.filter("numeric > 0").select(*key, able.alias("able"), _named(F.col("names")).alias("like")))
    named = F.zip_with("able", "like", lambda a, x: F.when(a, x).otherwise(0.0))
    known = chains.select(*key, named.alias("weights"))
    tells = F.array_max("weights") >= LEAST_WEIGHT
    values = columns.select(*key, F.inline(F.arrays_zip("h", "v"))).filter(F.abs("v") < TEXT_VALUES)
    field = F.array_position("weights", F.array_max("weights")).cast("int")
    reference = values.join(known.filter(tells), key).groupBy(field.alias("f"), "h").agg(F.percentile_approx("v", 0.5).alias("r"))
    agreed = (
        values.join(known.filter(~tells), key).join(reference, "h").groupBy(*key, "f").agg(F.avg(F.when(F.abs(F.col("v") - F.col("r")) <= 0.5 + 1e-3 * F.abs("r"), 1.0).otherwise(0.0)).alias("a"))
        .groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("f", "a"))).alias("a"))
    )
    by_value = F.array(*[F.when(F.get("able", F.lit(i)), F.greatest(F.get("like", F.lit(i)), UNNAMED_WEIGHT * F.element_at("a", F.lit(i + 1)))).otherwise(0.0) for i in range(len(FIELDS))])
    unnamed = chains.join(known.filter(~tells).select(*key), key, "left_semi").join(agreed, key).select(*key, by_value.alias("weights"))
    return known.filter(tells).unionByName(unnamed.filter(tells))


def _place(column: Column) -> Column:
    """For each field the number of the path that stands for it in one file, -1 where none does."""

    def best(weights: list) -> list[int]:
        rows = [[w[i] for w in weights] + [0.0] * len(FIELDS) for i in range(len(FIELDS))]
        return [j if row[j] >= LEAST_WEIGHT else -1 for row, j in zip(rows, matching.assign(rows))]

    return F.pandas_udf(lambda s: s.map(best), "array<int>")(column)


def placed(parts: DataFrame) -> DataFrame:
    """(feed, file_seq, rank, field, path, kind): where each field stands in each file that has it; one row with a null field for each file.

    Records without a feed or a number belong to no file.
    """
    files = staged(profiles(parts.filter("feed is not null and file_seq is not null")))
    nodes = staged(chained(linked(files)))
    usable = nodes.join(labelled(files, nodes), ["feed", "chain"])
    per_file = usable.groupBy(*FILE, "rank").agg(F.sort_array(F.collect_list(F.struct("path", "kind", "weights"))).alias("c"))
    at = per_file.withColumn("at", _place(F.col("c.weights")))
    rows = at.select(*FILE, "rank", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.get("c", F.get("at", F.lit(i))).alias("p")) for i, f in enumerate(FIELDS)])))
    found = rows.filter("p is not null").select(*FILE, "rank", "field", "p.path", "p.kind")
    none = F.lit(None).cast("string")
    return staged(found.unionByName(nodes.select(*FILE, "rank").distinct().select(*FILE, "rank", none.alias("field"), none.alias("path"), none.alias("kind"))))


def field_changes(catalog: DataFrame) -> DataFrame:
    """(feed, file_seq, field, change): added, removed, renamed or retyped against the file before in the feed. First files have none."""
    where = placed(leaves(catalog))
    files = where.filter("field is null").select("feed", "rank", "file_seq")
    fields = where.filter("field is not null")
    now = F.struct("path", "kind")
    both = fields.select("feed", "rank", "field", now.alias("now"), F.lit(None).alias("prev")).unionByName(fields.select("feed", (F.col("rank") + 1).alias("rank"), "field", F.lit(None).alias("now"), now.alias("prev")))
    m = both.groupBy("feed", "rank", "field").agg(F.max("now").alias("now"), F.max("prev").alias("prev")).filter("rank > 0").join(files, ["feed", "rank"])
    changes = F.array_compact(
        F.array(
            F.when(F.col("prev").isNull(), "added"),
            F.when(F.col("now").isNull(), "removed"),
            F.when(F.col("now.path") != F.col("prev.path"), "renamed"),
            F.when(F.col("now.kind") != F.col("prev.kind"), "retyped"),
        )
    )
    return m.select("feed", "file_seq", "field", F.explode(changes).alias("change"))


def unified(catalog: DataFrame) -> DataFrame:
    """(record_id, feed, file_seq, station, longitude, latitude, elevation): all records in degrees and metres, absent fields null."""
    parts = leaves(catalog)
    where = placed(parts).filter("path is not null").select(*FILE, "path", "field")
    values = parts.filter("value is not null").join(where, [*FILE, "path"]).groupBy("record_id").agg(*[F.min(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS])
    return catalog.select("record_id", *FILE, F.try_variant_get(F.try_parse_json("payload"), "$.station", "string").alias("station")).join(values, "record_id", "left")
