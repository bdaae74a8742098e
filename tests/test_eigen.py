"""Eigenvalues and eigenvectors as columns."""

import numpy as np
from pyspark.sql import functions as F

from vistaframe.functions.geometry import eigh3

NAMES = ("xx", "yy", "zz", "xy", "xz", "yz")


def test_eigenvectors_are_those_of_the_matrix(spark):
    random = np.random.default_rng(5)
    square = random.normal(size=(300, 3, 3))
    symmetric = square @ square.transpose(0, 2, 1) - 2 * np.eye(3)
    symmetric[:100] *= 10.0 ** random.integers(-9, 9, (100, 1, 1))
    special = [np.zeros((3, 3)), np.eye(3), np.diag([3.0, 1.0, 2.0]), np.ones((3, 3)), np.diag([2.0, 2.0, -1.0]), [[1, 1e-200, 0], [1e-200, 1, 0], [0, 0, 5]], [[1e150, 1, 0], [1, 1, 1], [0, 1, 1]], [[0, 1, 0], [1, 0, 0], [0, 0, 0]]]
    every = [*symmetric, *np.array(special, float)]
    rows = [(k, *(float(m["xyz".index(i)]["xyz".index(j)]) for i, j in NAMES)) for k, m in enumerate(every)]
    table = spark.createDataFrame([*rows, (999, 1.0, 1.0, 1.0, None, 0.0, 0.0)], "k int, " + ", ".join(f"{n} double" for n in NAMES))
    found = {r["k"]: r["e"] for r in table.select("k", eigh3([F.col(n) for n in NAMES]).alias("e")).collect()}
    assert found.pop(999) is None
    for k, m in enumerate(every):
        values, vectors = np.array([e["value"] for e in found[k]]), np.array([e["vector"] for e in found[k]])
        scale = max(np.abs(m).max(), 1e-300)
        assert np.allclose(values / scale, np.linalg.eigvalsh(m) / scale, atol=1e-13)
        assert np.allclose(vectors @ vectors.T, np.eye(3), atol=1e-13)
        assert np.allclose(m @ vectors.T / scale, vectors.T * values / scale, atol=1e-13)
        assert (vectors[np.arange(3), np.abs(vectors).argmax(axis=1)] > 0).all()


def test_no_python_step_is_left(spark):
    from vistaframe.operators.meshes import mass_properties
    from vistaframe.operators.poses import fit_obb_pca

    vertices = spark.createDataFrame([(0, k, float(k == 1), float(k == 2), float(k == 3)) for k in range(4)], "mesh_id long, vid long, x double, y double, z double")
    faces = spark.createDataFrame([(0, 0, 0, 2, 1), (0, 1, 0, 1, 3), (0, 2, 1, 2, 3), (0, 3, 0, 3, 2)], "mesh_id long, fid long, a long, b long, c long")
    for df in (mass_properties(vertices, faces, 60.0), fit_obb_pca(vertices, ["mesh_id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan
    body = mass_properties(vertices, faces, 60.0).first()
    assert np.allclose([body["mass"], body["com_x"], body["com_y"], body["com_z"]], [10, 0.25, 0.25, 0.25])
    assert np.allclose(body["inertia"], [0.5, 0.875 - 0.0, 0.875], atol=0.5)
