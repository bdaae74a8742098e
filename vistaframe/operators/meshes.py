"""Meshes as vertex and face tables: cleaning, reports, components, mass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vistaframe.functions.geometry import apply_transform, cross, dot, eigh3, matrix_of, norm
from vistaframe.operators.places import with_places

CORNERS = ("a", "b", "c")


def mesh_clean(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) without degenerate and repeated faces, equal vertices merged to the smallest id, unused ones dropped."""
    same = Window.partitionBy("mesh_id", "x", "y", "z")
    merged = vertices.withColumn("_to", F.min("vid").over(same))
    names = merged.select("mesh_id", "vid", "_to")
    for c in CORNERS:
        faces = faces.join(names.select("mesh_id", F.col("vid").alias(c), F.col("_to").alias("_new")), ["mesh_id", c]).withColumn(c, F.col("_new")).drop("_new")
    whole = faces.where("a <> b AND b <> c AND a <> c").withColumn("_set", F.array_sort(F.array(*CORNERS)))
    kept = whole.groupBy("mesh_id", "_set").agg(F.min_by(F.struct("fid", *CORNERS), "fid").alias("f")).select("mesh_id", "f.*")
    used = kept.select("mesh_id", F.explode(F.array(*CORNERS)).alias("vid")).distinct()
    return vertices.join(used, ["mesh_id", "vid"], "left_semi"), kept


def with_corners(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """faces with the coordinates of their corners, ax to cz."""
    for c in CORNERS:
        faces = faces.join(vertices.select("mesh_id", F.col("vid").alias(c), *[F.col(k).alias(f"{c}{k}") for k in "xyz"]), ["mesh_id", c])
    return faces


def _corner(c: str) -> list:
    return [F.col(f"{c}{k}") for k in "xyz"]


def face_normals(located: DataFrame) -> DataFrame:
    """located faces with area and the unit normal's z."""
    a, b, c = (_corner(k) for k in CORNERS)
    n = cross([x - y for x, y in zip(b, a, strict=True)], [x - y for x, y in zip(c, a, strict=True)])
    length = norm(n)
    return located.withColumns({"area": length / 2, "nz": n[2] / F.nullif(length, F.lit(0.0))})


def mesh_report(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Counts, volume (of the signed tetrahedra, absolute), area, bounds, extents, and whether every edge has exactly two faces."""
    located = face_normals(with_corners(vertices, faces))
    a, b, c = (_corner(k) for k in CORNERS)
    sums = located.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("faces"), F.abs(F.sum(dot(a, cross(b, c)))).alias("_v"), F.sum("area").alias("area"))
    per_edge = _edges(faces).groupBy("mesh_id", "e").agg(F.count(F.lit(1)).alias("n"))
    tight = per_edge.groupBy("mesh_id").agg(F.bool_and(F.col("n") == 2).alias("watertight"), F.count(F.lit(1)).alias("edges"))
    ends = [f(c).alias(f"{n}_{c}") for c in "xyz" for f, n in ((F.min, "min"), (F.max, "max"))]
    points = vertices.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("vertices"), *ends)
    extents = [(F.col(f"max_{c}") - F.col(f"min_{c}")).alias(f"extent_{c}") for c in "xyz"]
    return points.join(sums, "mesh_id").join(tight, "mesh_id").select("mesh_id", "vertices", "faces", "edges", "area", (F.col("_v") / 6).alias("volume"), "watertight", *[f"{n}_{c}" for c in "xyz" for n in ("min", "max")], *extents)


def nth_face_decimate(faces: DataFrame, target: int) -> DataFrame:
    """Every k-th face of a mesh in order of id, k its faces over the target rounded up; all if it has no more."""
    placed = with_places(faces, "mesh_id", ["fid"], total="_n")
    return placed.where(F.col("_at") % F.greatest(F.lit(1), F.ceil(F.col("_n") / target)) == 0).drop("_at", "_n")


def planar_uv(vertices: DataFrame) -> DataFrame:
    """vertices with texture coordinates: x and y over the mesh's extent."""
    box = vertices.groupBy("mesh_id").agg(*[f(c).alias(f"{n}{c}") for f, n in ((F.min, "lo"), (F.max, "hi")) for c in "xy"])
    part = lambda c: (F.col(c) - F.col(f"lo{c}")) / F.greatest(F.col(f"hi{c}") - F.col(f"lo{c}"), F.lit(1e-6))
    return vertices.join(F.broadcast(box), "mesh_id").select(*vertices.columns, part("x").alias("tu"), part("y").alias("tv"))


def mass_properties(vertices: DataFrame, faces: DataFrame, density: float) -> DataFrame:
    """(mesh_id, mass, com_x.., inertia, confidence) of each closed mesh: mass 1e-4 at least, centre of mass, principal moments of inertia
    (ascending, 1e-8 at least). An open mesh, or one without volume, has nulls and confidence 0.

    Sums are over the tetrahedra of the faces about the mesh's mean, which keeps them small.
    """
    mean = vertices.groupBy("mesh_id").agg(*[F.avg(c).alias(f"m{c}") for c in "xyz"])
    near = vertices.join(mean, "mesh_id").select("mesh_id", "vid", *[(F.col(c) - F.col(f"m{c}")).alias(c) for c in "xyz"])
    a, b, c = (_corner(k) for k in CORNERS)
    located = with_corners(near, faces).withColumn("_v", dot(a, cross(b, c)) / 6)
    first = [F.sum(F.col("_v") * (F.col(f"a{k}") + F.col(f"b{k}") + F.col(f"c{k}")) / 4).alias(f"_{k}") for k in "xyz"]
    total = lambda k: F.col(f"a{k}") + F.col(f"b{k}") + F.col(f"c{k}")
    # Integral of the product of two coordinates over a tetrahedron with a corner at the origin.
    second = [F.sum(F.col("_v") / 20 * (sum(F.col(f"{q}{i}") * F.col(f"{q}{j}") for q in CORNERS) + total(i) * total(j))).alias(f"_{i}{j}") for i, j in ("xx", "yy", "zz", "xy", "xz", "yz")]
    edges = _edges(faces).groupBy("mesh_id", "e").agg(F.count(F.lit(1)).alias("n")).groupBy("mesh_id").agg(F.bool_and(F.col("n") == 2).alias("_closed"))
    sums = located.groupBy("mesh_id").agg(F.sum("_v").alias("_v"), *first, *second).join(edges, "mesh_id").join(mean, "mesh_id")
    whole = F.when(F.col("_closed") & (F.abs("_v") > 1e-12), F.col("_v"))
    com = [F.col(f"_{k}") / whole for k in "xyz"]
    around = {f"{i}{j}": F.col(f"_{i}{j}") - whole * com["xyz".index(i)] * com["xyz".index(j)] for i, j in ("xx", "yy", "zz", "xy", "xz", "yz")}
    sign = F.signum(whole) * density
    tensor = [around["yy"] + around["zz"], around["xx"] + around["zz"], around["xx"] + around["yy"], -around["xy"], -around["xz"], -around["yz"]]
    rows = sums.select(
        "mesh_id", F.greatest(F.abs(whole) * density, F.lit(1e-4)).alias("mass"), *[(x + F.col(f"m{k}")).alias(f"com_{k}") for x, k in zip(com, "xyz", strict=True)],
        F.array(*[x * sign for x in tensor]).alias("tensor"), F.when(whole.isNotNull(), 0.9).otherwise(0.0).alias("confidence"),
    ).withColumn("mass", F.when(F.col("confidence") > 0, F.col("mass")))

    moments = F.transform(eigh3([F.get("tensor", F.lit(k)) for k in range(6)]), lambda e: F.greatest(e["value"], F.lit(1e-8)))
    return rows.withColumn("inertia", moments).select("mesh_id", "mass", *[f"com_{k}" for k in "xyz"], "confidence", "inertia")


def _edges(faces: DataFrame) -> DataFrame:
    return faces.select("mesh_id", F.explode(F.array(*[F.struct(F.least(p, q).alias("p"), F.greatest(p, q).alias("q")) for p, q in (("a", "b"), ("b", "c"), ("a", "c"))])).alias("e"))


def transform_mesh(vertices: DataFrame, transforms: DataFrame) -> DataFrame:
    """vertices through the matrix of their mesh (mesh_id, matrix); those of a mesh without one stay."""
    rows = vertices.join(transforms.select("mesh_id", F.col("matrix").alias("_m")), "mesh_id", "left")
    moved = dict(zip("xyz", apply_transform([F.col(c) for c in "xyz"], F.col("_m")), strict=True))
    return rows.select(*[F.coalesce(moved[c], c).alias(c) if c in moved else F.col(c) for c in vertices.columns])


def localize_mesh(vertices: DataFrame, mass: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices about their mesh's centre of mass, (mesh_id, local_to_world)). mass: mesh_id, com_x, com_y, com_z; a mesh without a
    centre stays where it is."""
    com = mass.select("mesh_id", *[F.coalesce(f"com_{c}", F.lit(0.0)).alias(f"_{c}") for c in "xyz"])
    rows = vertices.join(com, "mesh_id", "left")
    local = rows.select(*[(F.col(c) - F.coalesce(f"_{c}", F.lit(0.0))).alias(c) if c in "xyz" else F.col(c) for c in vertices.columns])
    eye = [F.lit(1.0 if i == j else 0.0) for i in range(3) for j in range(3)]
    return local, com.select("mesh_id", matrix_of(eye, [F.col(f"_{c}") for c in "xyz"]).alias("local_to_world"))


#: An object wider than this is replaced by a box of so much of its size, between these bounds.
WIDEST, SHRUNK, BOX_SIDES = 0.6, 0.45, (0.08, 0.45)


def clamp_extent(reports: DataFrame) -> DataFrame:
    """reports (mesh_report()) with clamped, and the centre and sides of the box that replaces a mesh that is too wide (null: it stays)."""
    wide = F.greatest(*[F.col(f"extent_{c}") for c in "xyz"]) > WIDEST
    middle = [F.when(wide, (F.col(f"min_{c}") + F.col(f"max_{c}")) / 2).alias(f"box_c{c}") for c in "xyz"]
    sides = [F.when(wide, F.least(F.greatest(F.col(f"extent_{c}") * SHRUNK, F.lit(BOX_SIDES[0])), F.lit(BOX_SIDES[1]))).alias(f"box_{c}") for c in "xyz"]
    return reports.select("*", wide.alias("clamped"), *middle, *sides)


def finalize_objects(vertices: DataFrame, faces: DataFrame, transforms: DataFrame, density: float, production: bool = False, target: int = 20_000) -> dict[str, DataFrame]:
    """visual (vertices, faces), collision faces, report, mass and placement of object meshes: cleaned, moved to the world, cleaned again,
    weighed, put about their centre of mass, and thinned for collision. In production an open mesh is an error."""
    vertices, faces = mesh_clean(vertices, faces)
    vertices, faces = mesh_clean(transform_mesh(vertices, transforms), faces)
    report = mesh_report(vertices, faces)
    if production:
        open_mesh = F.raise_error(F.concat(F.lit("not watertight: "), F.col("mesh_id"))).cast("boolean")
        report = report.withColumn("watertight", F.when(F.col("watertight"), F.lit(True)).otherwise(open_mesh))
    mass = mass_properties(vertices, faces, density)
    local, placement = localize_mesh(vertices, mass)
    return {"vertices": local, "faces": faces, "collision": nth_face_decimate(faces, min(20_000, max(256, target // 4))), "report": report, "mass": mass, "placement": placement}


def static_scene_report(vertices: DataFrame, faces: DataFrame, transforms: DataFrame, target: int, hashes: DataFrame) -> dict[str, DataFrame]:
    """vertices, collision and proxy faces, the kind of each component (chunks), and artifacts (mesh_id, artifact_id, kind, transform_hash) of
    static meshes moved to the world. hashes: mesh_id, transform_hash."""
    from vistaframe.operators.graph import classify_components, face_components

    vertices, faces = mesh_clean(transform_mesh(vertices, transforms), faces)
    collision = nth_face_decimate(faces, target)
    proxy = nth_face_decimate(collision, max(10_000, target // 4))
    chunks = classify_components(face_normals(with_corners(vertices, face_components(faces))))
    fixed = F.array(*[F.struct(F.lit(a).alias("artifact_id"), F.lit(k).alias("kind")) for a, k in (("static_collision_mesh", "triangle_collision_mesh"), ("static_render_proxy", "render_proxy_mesh"))])
    meshes = vertices.select("mesh_id").distinct().select("mesh_id", F.explode(fixed).alias("a")).select("mesh_id", "a.*")
    parts = chunks.select("mesh_id", F.concat(F.lit("static_chunk_"), "kind").alias("artifact_id"), F.lit("static_mesh_chunk").alias("kind")).distinct()
    artifacts = meshes.unionByName(parts).join(hashes, "mesh_id", "left")
    return {"vertices": vertices, "collision": collision, "proxy": proxy, "chunks": chunks, "artifacts": artifacts}
