"""Pipe-delimited tables, settings, OSM JSON and geometry text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mercato.session import path_exists, remove_dir

OSM = "elements array<struct<type:string,id:long,lon:double,lat:double,nodes:array<long>,tags:map<string,string>>>, _corrupt_record string"


def read_psv(spark: SparkSession, path: str, schema: str | T.StructType, optional: bool = False) -> DataFrame:
    """Header row, doubled quotes, blanks as null; a missing optional file is an empty table."""
    if optional and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, sep="|", header=True, escape='"', schema=schema, enforceSchema=False)


def write_psv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="|", header=True, escape='"')


def setting(table: DataFrame, name: str) -> str | None:
    """A value of a name|value table."""
    row = table.where(F.col("name") == name).select("value").first()
    return row[0] if row else None


def attribute_columns(df: DataFrame, fixed: tuple[str, ...] = ("siteId", "lon", "lat")) -> list[str]:
    return [c for c in df.columns if c not in fixed]


def read_rows(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A table by position: the header row is skipped, the first columns get these names, as strings."""
    raw = spark.read.csv(path, sep="|", header=True, escape='"')
    return raw.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(raw.columns, names)))


def single_row(df: DataFrame):
    """The only row of a parameter table; none or several are an error."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"a table of one row is wanted, this has {'none' if not rows else 'several'}")
    return rows[0]


def rounded_text(c: Column | str, places: int) -> Column:
    """A number with so many decimals, halves to the even digit."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c, places).cast(f"decimal(38,{places})").cast("string")


def write_rounded(df: DataFrame, path: str, places: dict[str, int]) -> None:
    """The table as it is, header and column order too, but for numbers with fixed decimals."""
    write_psv(df.select(*(rounded_text(c, places[c]).alias(c) if c in places else F.col(c) for c in df.columns)), path)


def read_osm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes: node, lon, lat; ways: way, highway, oneway, nodes); files that can't be parsed are left out.

    Of a node or way in several files, or twice in one, the first counts, in the order of file names.
    """
    raw = spark.read.json(path, multiLine=True, mode="PERMISSIVE", schema=OSM).withColumn("file", F.col("_metadata.file_path")).where("_corrupt_record is null")
    e = raw.select("file", F.posexplode("elements").alias("pos", "e")).select("file", "pos", "e.*")
    place = F.struct("file", "pos")
    nodes = e.where("type = 'node'").groupBy(F.col("id").alias("node")).agg(F.min_by(F.struct("lon", "lat"), place).alias("f")).select("node", "f.*")
    way = F.struct(F.col("tags")["highway"].alias("highway"), F.col("tags")["oneway"].eqNullSafe("yes").alias("oneway"), "nodes")
    ways = e.where("type = 'way'").groupBy(F.col("id").alias("way")).agg(F.min_by(way, place).alias("f")).select("way", "f.*")
    return nodes, ways


def write_grid(df: DataFrame, path: str, size: float, x: str = "xx", y: str = "yy") -> None:
    """The stored index: the table by grid cell, so that a box reads its own files alone."""
    cells = df.withColumns({"grid_x": F.floor(F.col(x) / size).cast("long"), "grid_y": F.floor(F.col(y) / size).cast("long")})
    cells.repartition("grid_x").sortWithinPartitions("grid_x", "grid_y").write.mode("overwrite").partitionBy("grid_x").parquet(path)


def read_box(spark: SparkSession, path: str, size: float, x0: float, y0: float, x1: float, y1: float, x: str = "xx", y: str = "yy") -> DataFrame:
    """Rows of a stored index inside a box, its rim included."""
    own = spark.read.parquet(path).where(F.col("grid_x").between(int(x0 // size), int(x1 // size)) & F.col("grid_y").between(int(y0 // size), int(y1 // size)))
    return own.where(F.col(x).between(x0, x1) & F.col(y).between(y0, y1)).drop("grid_x", "grid_y")


def show(df: DataFrame, limit: int = 20) -> str:
    """The first rows as text, for a look."""
    head = df.limit(limit).collect()
    return "\n".join(["|".join(df.columns), *("|".join("" if v is None else str(v) for v in r) for r in head)])


def delete_outputs(spark: SparkSession, base: str, names: list[str]) -> None:
    """Remove the outputs of one family below a folder; missing ones are no error."""
    for n in names:
        remove_dir(spark, f"{base.rstrip('/')}/{n}")


FEATURES = "type string, properties map<string,string>, geometry struct<type:string,coordinates:string>"


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(feature, properties, kind, part, ring, seq, x, y): the points of GeoJSON features, one a line.

    Parts are those of a MultiPolygon, ring 0 of a part is its outline and the others its holes.
    """
    f = spark.read.schema(FEATURES).json(path).where("geometry is not null")
    f = f.select(F.xxhash64(F.to_json("geometry"), F.to_json("properties")).alias("feature"), "properties", F.col("geometry.type").alias("kind"), F.col("geometry.coordinates").alias("c"))
    deep = {"Point": 0, "MultiPoint": 1, "LineString": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}
    rings = F.lit(None).cast("array<array<array<array<double>>>>")
    for kind, d in deep.items():
        text = F.concat(F.lit("[" * (3 - d)), F.col("c"), F.lit("]" * (3 - d)))
        rings = F.when(F.col("kind") == kind, F.from_json(text, "array<array<array<array<double>>>>")).otherwise(rings)
    f = f.select("feature", "properties", "kind", F.posexplode(rings).alias("part", "p"))
    f = f.select("feature", "properties", "kind", "part", F.posexplode("p").alias("ring", "r"))
    f = f.select("feature", "properties", "kind", "part", "ring", F.posexplode("r").alias("seq", "at"))
    return f.select("feature", "properties", "kind", "part", "ring", "seq", F.col("at")[0].alias("x"), F.col("at")[1].alias("y"))


def only_polygons(features: DataFrame) -> DataFrame:
    return features.where(F.col("kind").isin("Polygon", "MultiPolygon"))


def boundary(spark: SparkSession, path: str, projection=None) -> DataFrame:
    """(area, ring, seq, x, y) of the first feature of an area's boundary file, in degrees or, by a projection, in metres."""
    points = read_features(spark, path)
    first = points.agg(F.min("feature").alias("feature"))
    rings = points.join(first, "feature", "left_semi").withColumn("ring", F.col("part") * 1000 + F.col("ring"))
    if projection is not None:
        x, y = projection.forward(F.col("x"), F.col("y"))
        rings = rings.withColumns({"x": x, "y": y})
    return rings.select(F.lit(0).alias("area"), "ring", "seq", "x", "y")


def geojson(kind: str, points: Column, **props: Column) -> Column:
    """A GeoJSON feature from an array of (x, y): Point takes the first, Polygon one ring."""
    pair = F.transform(points, lambda p: F.array(p["x"], p["y"]))
    coords = {"Point": F.get(pair, F.lit(0)), "LineString": pair, "MultiPoint": pair, "Polygon": F.array(pair)}[kind]
    geometry = F.struct(F.lit(kind).alias("type"), coords.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*(c.alias(n) for n, c in props.items())).alias("properties"), geometry.alias("geometry")))


def write_features(df: DataFrame, kind: str, points: str, props: list[str], path: str) -> None:
    """One GeoJSON feature a line."""
    df.select(geojson(kind, F.col(points), **{p: F.col(p) for p in props}).alias("value")).write.mode("overwrite").text(path)


def write_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    vertices.write.mode("overwrite").parquet(f"{path}/vertices")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges")
