"""Scene-capture views derived from the driver's tables; one text for Spark and for the oracle's engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vistaframe.sources.tables import ship



#: Name: (views or tables it stands on, query). {E} takes an array's element, {S} is the text type, {T<n>} repeats each row with k from 0 to n - 1.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_emb": (("embeddings",), "SELECT concat('s', label) AS scene_id, vec_id * 21 + j AS pid, j, vec_id, CAST({E}(embedding, 3 * j + 1) AS DOUBLE) * 1e1 AS x, CAST({E}(embedding, 3 * j + 2) AS DOUBLE) * 1e1 AS y, CAST({E}(embedding, 3 * j + 3) AS DOUBLE) * 1e1 AS z FROM (SELECT *, k AS j FROM embeddings {T21}) t"),
    "points": (("fx_emb",), "SELECT scene_id, pid AS point_id, x, y, z, pid % 256 AS r, (pid * 3) % 256 AS g, (pid * 7) % 256 AS b FROM fx_emb"),
    "gaussians": (("fx_emb",), "SELECT scene_id, pid AS gaussian_id, CASE WHEN pid % 97 = 0 THEN x * 8e0 ELSE x END AS x, CASE WHEN pid % 97 = 0 THEN y * 8e0 ELSE y END AS y, CASE WHEN pid % 97 = 0 THEN z * 8e0 ELSE z END AS z, CAST((pid * 13) % 100 AS DOUBLE) / 1e2 AS opacity, 2e-2 + CAST(pid % 11 AS DOUBLE) / 5e1 AS sx, 2e-2 + CAST(pid % 7 AS DOUBLE) / 5e1 AS sy, CASE WHEN pid % 211 = 0 THEN 9e0 ELSE 2e-2 END AS sz FROM fx_emb"),
    "fx_img": (("supplier",), "SELECT s_suppkey AS i, CAST((s_suppkey * 37) % 200 - 100 AS DOUBLE) / 1e2 AS t, s_nationkey AS camera_id FROM supplier"),
    "images": (("fx_img",), "SELECT concat('s', i % 10) AS scene_id, i AS image_id, concat('frame_', lpad(CAST(i AS {S}), 6, '0'), '.jpg') AS name, camera_id, (1e0 - t * t) / (1e0 + t * t) AS qw, 0e0 AS qx, 2e0 * t / (1e0 + t * t) AS qy, 0e0 AS qz, CAST(i % 7 - 3 AS DOUBLE) / 5e0 AS tx, CAST(i % 3 - 1 AS DOUBLE) / 5e0 AS ty, 1e0 + CAST(i % 5 AS DOUBLE) / 2e0 AS tz FROM fx_img"),
    "cameras": (("nation",), "SELECT concat('s', k) AS scene_id, n_nationkey AS camera_id, CASE n_regionkey WHEN 0 THEN 'PINHOLE' WHEN 1 THEN 'OPENCV' WHEN 2 THEN 'SIMPLE_PINHOLE' WHEN 3 THEN 'SIMPLE_RADIAL' ELSE 'RADIAL' END AS model, 640 AS width, 480 AS height, 5e2 AS fx, CASE WHEN n_regionkey < 2 THEN 5.2e2 ELSE 5e2 END AS fy, 3.2e2 AS cx, 2.4e2 AS cy FROM nation {T10} WHERE n_nationkey <> 24"),
    "labels2d": (("fx_img",), "SELECT concat('s', i % 10) AS scene_id, i AS image_id, b AS ordinal, (i + b) % 3 AS class_id, 2e-1 + CAST(b AS DOUBLE) / 5e0 AS xc, 5e-1 AS yc, 3e-1 AS w, 4e-1 AS h FROM (SELECT *, k AS b FROM fx_img {T4}) t"),
    "detections": (("events",), "SELECT concat('s', user_id % 10) AS scene_id, event_id AS ordinal, concat('frame_', lpad(CAST(CAST(floor(event_id / 1e1) AS BIGINT) AS {S}), 6, '0'), '.jpg') AS frame, event_type AS class_name, value / (value + 5e1) AS confidence, CAST((k % 10) * 20 AS DOUBLE) AS x0, CAST((user_id % 3) * 40 AS DOUBLE) AS y0, CAST((k % 10) * 20 + 60 + user_id % 40 AS DOUBLE) AS x1, CAST((user_id % 3) * 40 + 80 AS DOUBLE) AS y1 FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e"),
    "frames": (("documents",), "SELECT doc_id AS frame_id, source AS session, concat(source, '/frame_', lpad(CAST(doc_id AS {S}), 6, '0'), '.jpg') AS path, CAST(n_chars % 300 AS DOUBLE) AS sharpness, (n_chars * 7) % 2000 AS features FROM documents"),
    "view_metrics": (("orders",), "SELECT concat('s', o_custkey % 10) AS scene_id, o_custkey % 12 AS trial, o_orderkey AS view_id, CASE WHEN o_orderpriority = '1-URGENT' THEN CAST('Infinity' AS DOUBLE) ELSE o_totalprice / 1e4 END AS psnr, CAST(o_orderkey % 101 AS DOUBLE) / 1e2 AS ssim, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 53 AS DOUBLE) / 1e2 END AS lpips FROM orders"),
    "checks": (("orders",), "SELECT concat('s', o_custkey % 10) AS scene_id, o_orderkey AS ordinal, o_orderpriority AS name, o_orderstatus <> 'F' AS passed, o_orderkey % 3 = 0 AS required FROM orders"),
    "trials": (("part",), "SELECT p_partkey AS ordinal, CASE WHEN p_size % 5 = 0 THEN 'retrain' ELSE 'cheap' END AS kind, CASE WHEN p_size % 7 = 0 THEN 'failed' ELSE 'scored' END AS status, CAST(1 + p_size % 6 AS DOUBLE) AS outlier_std, CAST(1 + p_partkey % 5 AS DOUBLE) / 1e2 AS min_opacity, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST((p_partkey * 17) % 1000 AS DOUBLE) / 1e1 END AS quality_score FROM part"),
    "artifacts": (("part",), "SELECT concat('s', p_partkey % 10) AS scene_id, concat('a', p_partkey) AS artifact_id, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE md5(p_brand) END AS transform_hash, p_partkey % 9 <> 0 AS file_exists FROM part"),
    "mask_pixels": (("lineitem",), "SELECT DISTINCT concat('s', l_suppkey % 10) AS scene_id, concat('i', l_partkey % 6) AS instance_id, l_orderkey % 20 AS frame, CAST(l_quantity AS INT) AS u, l_linenumber AS v FROM lineitem"),
    "fx_ids": (("orders",), "SELECT CAST(greatest(floor(count(*) / 3e1), 50) AS BIGINT) AS n FROM orders"),
    "faces": (("fx_ids",), "SELECT concat('s', o_custkey % 10) AS scene_id, o_orderkey AS fid, (o_orderkey % (SELECT n FROM fx_ids)) * 10 + o_custkey % 10 AS a, (o_custkey % (SELECT n FROM fx_ids)) * 10 + o_custkey % 10 AS b, ((o_orderkey * 7) % (SELECT n FROM fx_ids)) * 10 + o_custkey % 10 AS c FROM orders"),
    "objects": (("part",), "SELECT concat('s', p_partkey % 10) AS scene_id, concat('o', p_partkey) AS instance_id, p_partkey AS k, p_size AS size, p_partkey % 3 <> 0 AS movable, CASE p_partkey % 4 WHEN 1 THEN 'pending' WHEN 2 THEN 'rejected' ELSE 'approved' END AS review_state, CAST(p_size % 10 AS DOUBLE) / 1e1 AS coverage FROM part"),
    "boxes3d": (("part",), "SELECT concat('s', p_partkey % 10) AS scene_id, p_partkey AS k, CAST(p_partkey % 7 AS DOUBLE) AS cx, CAST(p_partkey % 5 AS DOUBLE) AS cy, CAST(p_partkey % 3 AS DOUBLE) AS cz, (1e0 - t * t) / (1e0 + t * t) AS c, 2e0 * t / (1e0 + t * t) AS s FROM (SELECT p_partkey, CAST(p_partkey % 21 - 10 AS DOUBLE) / 1e1 AS t FROM part) x"),
    "pixel_pairs": (("orders",), "SELECT o_custkey % 50 AS image_id, o_orderkey AS px, CAST(o_orderkey % 256 AS DOUBLE) / 2.55e2 AS ref, CAST((o_orderkey + o_custkey) % 256 AS DOUBLE) / 2.55e2 AS render FROM orders"),
}


def ctes(names: tuple[str, ...], element: str, text: str, repeat: str) -> str:
    """The named views and those they stand on, as the body of a WITH clause."""
    found: dict[str, str] = {}

    def add(name: str) -> None:
        for below in VIEWS[name][0]:
            if below in VIEWS and below not in found:
                add(below)
        found.setdefault(name, VIEWS[name][1].format(E=element, S=text, **{f"T{n}": repeat.format(n=n, last=n - 1) for n in (4, 10, 21)}))

    for name in names:
        add(name)
    return ", ".join(f"{name} AS ({query})" for name, query in found.items())


def tables_of(name: str) -> set[str]:
    """The driver's tables that a view stands on."""
    return {name} if name not in VIEWS else set().union(*map(tables_of, VIEWS[name][0]))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the tables of sf_dir. A table is registered once for a session, until another sf_dir is asked for."""
    ship(spark)
    known = spark.__dict__.setdefault("_vistaframe_tables", {})
    for table in sorted(tables_of(name)):
        if known.get(table) != sf_dir:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
            known[table] = sf_dir
    return spark.sql(f"WITH {ctes((name,), 'element_at', 'STRING', 'LATERAL VIEW explode(sequence(0, {last})) x AS k')} SELECT * FROM {name}")


def oracle(query: str, *names: str) -> str:
    """SQL for the oracle's engine: the query over the named views; it may start with CTEs of its own after `WITH`."""
    own = query.strip()
    body = ctes(names, "list_extract", "VARCHAR", "CROSS JOIN (SELECT CAST(unnest(range({n})) AS INT) AS k) x")
    if own.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {body}, {own.removeprefix('WITH RECURSIVE ')}"
    return f"WITH {body}, {own.removeprefix('WITH ')}" if own.startswith("WITH ") else f"WITH {body} {own}"
