"""Column builders for poses, projections, boxes and transforms. Everything here stays inside generated code: no UDFs.

Vectors are tuples of columns, rotations are tuples of nine columns in row order, homogeneous matrices are arrays of 16
doubles in row order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = Sequence[Column]

#: Camera models whose first parameter is the focal length of both axes.
ONE_FOCAL = ("SIMPLE_PINHOLE", "SIMPLE_RADIAL", "RADIAL")
#: Camera models that a projection accepts; their distortion is ignored.
PROJECTED = ("SIMPLE_PINHOLE", "PINHOLE", "OPENCV")


def dot(a: Vector, b: Vector) -> Column:
    return reduce(add, (x * y for x, y in zip(a, b, strict=True)))


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Vector, b: Vector) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def clip(x: Column, low: float | Column, high: float | Column) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def quat_to_rotmat(q: Vector, normalize: bool = False) -> list[Column]:
    """The nine terms of the rotation of a quaternion (w, x, y, z), taken as it is or divided by its norm first."""
    if normalize:
        n = norm(q)
        q = [c / n for c in q]
    w, x, y, z = q
    return [
        1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y),
        2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x),
        2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y),
    ]


def rotmat_to_quat(r: Vector) -> list[Column]:
    """(w, x, y, z) of a rotation, by the largest diagonal sum so that no divisor is small; normalised."""
    trace = r[0] + r[4] + r[8]
    s0 = F.sqrt(F.greatest(trace + 1, F.lit(0.0))) * 2
    s1 = F.sqrt(F.greatest(1 + r[0] - r[4] - r[8], F.lit(0.0))) * 2
    s2 = F.sqrt(F.greatest(1 + r[4] - r[0] - r[8], F.lit(0.0))) * 2
    s3 = F.sqrt(F.greatest(1 + r[8] - r[0] - r[4], F.lit(0.0))) * 2
    on_x = (r[0] > r[4]) & (r[0] > r[8])
    pick = lambda a, b, c, d: F.when(trace > 0, a).when(on_x, b).when(r[4] > r[8], c).otherwise(d)
    safe = lambda x: F.nullif(x, F.lit(0.0))
    q = [
        pick(s0 / 4, (r[7] - r[5]) / safe(s1), (r[2] - r[6]) / safe(s2), (r[3] - r[1]) / safe(s3)),
        pick((r[7] - r[5]) / safe(s0), s1 / 4, (r[1] + r[3]) / safe(s2), (r[2] + r[6]) / safe(s3)),
        pick((r[2] - r[6]) / safe(s0), (r[1] + r[3]) / safe(s1), s2 / 4, (r[5] + r[7]) / safe(s3)),
        pick((r[3] - r[1]) / safe(s0), (r[2] + r[6]) / safe(s1), (r[5] + r[7]) / safe(s2), s3 / 4),
    ]
    n = norm(q) + 1e-12
    return [c / n for c in q]


def rotate(r: Vector, v: Vector) -> list[Column]:
    return [dot(r[k : k + 3], v) for k in (0, 3, 6)]


def rotate_back(r: Vector, v: Vector) -> list[Column]:
    """The transposed rotation of v."""
    return [dot([r[k], r[k + 3], r[k + 6]], v) for k in (0, 1, 2)]


def camera_center(q: Vector, t: Vector) -> list[Column]:
    return [-c for c in rotate_back(quat_to_rotmat(q), t)]


def camera_up(q: Vector) -> list[Column]:
    """The world direction that is up in the image."""
    r = quat_to_rotmat(q)
    return [-r[3], -r[4], -r[5]]


def c2w_to_w2c(c2w: Column) -> list[Column]:
    """Rotation (nine) and translation (three) from world to camera of a camera-to-world matrix."""
    m = [F.get(c2w, F.lit(k)) for k in range(16)]
    r = [m[0], m[4], m[8], m[1], m[5], m[9], m[2], m[6], m[10]]
    return [*r, *[-c for c in rotate(r, [m[3], m[7], m[11]])]]


def focal_terms(model: Column, fx: Column, fy: Column) -> tuple[Column, Column]:
    """Focal lengths of both axes; models with one focal length use the first for both."""
    return fx, F.when(model.isin(*ONE_FOCAL), fx).otherwise(fy)


def camera_space(xyz: Vector, q: Vector, t: Vector) -> list[Column]:
    return [a + b for a, b in zip(rotate(quat_to_rotmat(q), xyz), t, strict=True)]


def pinhole(camera: Vector, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column]:
    """(u, v, depth) of a point in camera space; a tiny number keeps the divisor from zero."""
    z = camera[2] + 1e-12
    return fx * camera[0] / z + cx, fy * camera[1] / z + cy, camera[2]


def project_w2c(xyz: Vector, q: Vector, t: Vector, model: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column]:
    """(u, v, depth); an error for camera models other than PROJECTED."""
    known = F.when(model.isin(*PROJECTED), fx).otherwise(F.raise_error(F.concat(F.lit("no projection for camera model "), model)).cast("double"))
    return pinhole(camera_space(xyz, q, t), *focal_terms(model, known, fy), cx, cy)


def intrinsics_from_meta(fl_x: Column, fl_y: Column, angle_x: Column, width: Column) -> tuple[Column, Column]:
    """Focal lengths from metadata: as given, else from the horizontal angle, else 0.8 of the width."""
    fallback = F.coalesce(width / 2 / F.tan(angle_x / 2), width * 0.8)
    x = F.coalesce(fl_x, fallback)
    return x, F.coalesce(fl_y, x)


def fov_deg(fl_x: Column, fl_y: Column, angle_x: Column, width: Column, height: Column) -> Column:
    """Vertical field of view in degrees: from the horizontal angle and the aspect, else from the mean focal length, else 60."""
    by_angle = F.degrees(2 * F.atan(F.tan(angle_x / 2) * height / width))
    by_focal = F.degrees(2 * F.atan(height / (fl_x + fl_y)))
    return F.coalesce(by_angle, by_focal, F.lit(60.0))


def rescale_intrinsics(width: Column, height: Column, terms: Vector, k: int) -> tuple[Column, Column, list[Column]]:
    """Size (whole pixels, 1 at least) and pinhole terms of an image reduced k times."""
    return F.greatest(F.floor(width / k), F.lit(1)), F.greatest(F.floor(height / k), F.lit(1)), [t / k for t in terms]


def apply_transform(xyz: Vector, m: Column) -> list[Column]:
    """A homogeneous 4x4 matrix times a column vector."""
    return [dot([F.get(m, F.lit(4 * row + k)) for k in range(3)], xyz) + F.get(m, F.lit(4 * row + 3)) for row in range(3)]


def matmul44(a: Column, b: Column) -> Column:
    """The product of two 4x4 matrices."""
    cell = lambda i, j: dot([F.get(a, F.lit(4 * i + k)) for k in range(4)], [F.get(b, F.lit(4 * k + j)) for k in range(4)])
    return F.array(*[cell(i, j) for i in range(4) for j in range(4)])


def transform_aabb(low: Vector, high: Vector, m: Column, scale: float = 1.0) -> tuple[list[Column], list[Column]]:
    """The axis-aligned box of a transformed one: per axis, each matrix term takes the nearer or the farther face."""
    lows, highs = [], []
    for row in range(3):
        ends = [(F.get(m, F.lit(4 * row + k)) * low[k], F.get(m, F.lit(4 * row + k)) * high[k]) for k in range(3)]
        shift = F.get(m, F.lit(4 * row + 3))
        lows.append((reduce(add, (F.least(a, b) for a, b in ends)) + shift) * scale)
        highs.append((reduce(add, (F.greatest(a, b) for a, b in ends)) + shift) * scale)
    return lows, highs


def linear_columns(m: Column) -> list[list[Column]]:
    return [[F.get(m, F.lit(4 * row + k)) for row in range(3)] for k in range(3)]


def determinant(m: Column) -> Column:
    a, b, c = linear_columns(m)
    return dot(a, cross(b, c))


def uniform_scale(m: Column) -> Column:
    """The scale of a similarity transform: the cube root of its determinant."""
    return F.cbrt(determinant(m))


def is_similarity(m: Column) -> Column:
    """Whether a matrix is a right-handed rotation times one scale plus a translation."""
    scale = uniform_scale(m)
    columns = linear_columns(m)
    off = [F.abs(dot(columns[i], columns[j])) / (scale * scale) < 1e-6 for i, j in ((0, 1), (0, 2), (1, 2))]
    on = [F.abs(norm(c) / scale - 1) < 1e-5 for c in columns]
    last = [F.get(m, F.lit(12 + k)) == (1.0 if k == 3 else 0.0) for k in range(4)]
    return F.coalesce((determinant(m) > 1e-12) & reduce(and_, [*off, *on, *last]), F.lit(False))


def rotation_to_up(n: Vector) -> list[Column]:
    """Nine terms of the smallest rotation that turns the unit vector n to +z; half a turn about x for -z."""
    x, y, z = n
    k = 1 / F.nullif(1 + z, F.lit(0.0))
    turned = [1 - x * x * k, -x * y * k, -x, -x * y * k, 1 - y * y * k, -y, x, y, z]
    flip = [1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, -1.0]
    same = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    return [F.when(z > 1 - 1e-12, F.lit(s)).when(z < -1 + 1e-12, F.lit(f)).otherwise(t) for t, s, f in zip(turned, same, flip, strict=True)]


def label_to_xyxy(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    return [(xc - w / 2) * width, (yc - h / 2) * height, (xc + w / 2) * width, (yc + h / 2) * height]


def xyxy_to_label(box: Vector, width: Column, height: Column) -> list[Column]:
    w, h = F.greatest(width, F.lit(1)), F.greatest(height, F.lit(1))
    return [(box[0] + box[2]) / 2 / w, (box[1] + box[3]) / 2 / h, (box[2] - box[0]) / w, (box[3] - box[1]) / h]


def _overlap(a: Vector, b: Vector) -> tuple[Column, Column]:
    zero = F.lit(0.0)
    side = lambda k: F.greatest(F.least(a[k + 2], b[k + 2]) - F.greatest(a[k], b[k]), zero)
    area = lambda x: F.greatest(x[2] - x[0], zero) * F.greatest(x[3] - x[1], zero)
    both = side(0) * side(1)
    return both, area(a) + area(b) - both


def box_iou(a: Vector, b: Vector) -> Column:
    both, union = _overlap(a, b)
    return both / F.greatest(union, F.lit(1e-9))


def label_iou(a: Vector, class_a: Column, b: Vector, class_b: Column) -> Column:
    both, union = _overlap(a, b)
    return F.when(class_a == class_b, both / (union + 1e-6)).otherwise(0.0)


def slerp(q0: Vector, q1: Vector, t: Column) -> list[Column]:
    """Between unit quaternions along the shorter arc; a straight mix where they nearly agree; normalised."""
    d = dot(q0, q1)
    sign = F.when(d < 0, -1.0).otherwise(1.0)
    angle = F.acos(clip(d * sign, -1.0, 1.0))
    near = d * sign > 0.9995
    over = F.nullif(F.sin(angle), F.lit(0.0))
    a = F.when(near, 1 - t).otherwise(F.sin((1 - t) * angle) / over)
    b = F.when(near, t).otherwise(F.sin(t * angle) / over) * sign
    mixed = [x * a + y * b for x, y in zip(q0, q1, strict=True)]
    n = norm(mixed)
    return [c / n for c in mixed]


def project_c2w(xyz: Vector, c2w: Column, model: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column]:
    """(u, v, depth) by a camera-to-world matrix; an error for camera models other than PROJECTED."""
    terms = c2w_to_w2c(c2w)
    camera = [a + b for a, b in zip(rotate(terms[:9], xyz), terms[9:], strict=True)]
    known = F.when(model.isin(*PROJECTED), fx).otherwise(F.raise_error(F.concat(F.lit("no projection for camera model "), model)).cast("double"))
    return pinhole(camera, *focal_terms(model, known, fy), cx, cy)


def transform_pose(c2w: Column, m: Column) -> Column:
    """A camera-to-world pose seen from the frame that m leads to."""
    return matmul44(m, c2w)


def matrix_of(r: Vector, t: Vector) -> Column:
    """A 4x4 matrix of nine linear terms and a translation."""
    rows = [x for k in range(3) for x in (*r[3 * k : 3 * k + 3], t[k])]
    return F.array(*rows, *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])


def whole_matrix(m: Column) -> Column:
    """A 3x4 matrix (12 numbers) completed to 4x4; one of 16 numbers as it is."""
    return F.when(F.size(m) == 12, F.concat(m, F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]))).otherwise(m)


def apply_capture_transform(xyz: Vector, m: Column) -> list[Column]:
    """Points of the capture in the frame of its exported cameras; a null matrix leaves them."""
    return [F.coalesce(a, b) for a, b in zip(apply_transform(xyz, whole_matrix(m)), xyz, strict=True)]


def apply_trained_transform(xyz: Vector, m: Column, scale: Column) -> list[Column]:
    """Points in the frame a model was trained in: the matrix (3x4 or 4x4), then one scale."""
    return [c * scale for c in apply_transform(xyz, whole_matrix(m))]


def compose_similarity(r: Vector, t: Vector, scale: Column) -> Column:
    """The 4x4 matrix of a rotation, translation and scale; an error for a scale of 0 or less, or for what is no right-handed rotation."""
    rows = [r[3 * k : 3 * k + 3] for k in range(3)]
    columns = [[r[k], r[k + 3], r[k + 6]] for k in range(3)]
    square = reduce(and_, [F.abs(dot(columns[i], columns[j]) - (1.0 if i == j else 0.0)) <= 1.1e-6 for i in range(3) for j in range(i, 3)])
    right = dot(rows[0], cross(rows[1], rows[2])) > 0
    wrong = lambda text: F.raise_error(F.lit(text)).cast("double")
    checked = F.when(~(scale > 0), wrong("scale must be positive")).when(~square, wrong("rotation must be orthonormal")).when(~right, wrong("rotation must be right-handed")).otherwise(scale)
    return matrix_of([c * checked for c in r], t)


def meters_per_unit(known: Column, measured: Column) -> Column:
    """Metres of one unit from a known and a measured length; an error unless both are above 0."""
    return F.when((known > 0) & (measured > 0), known / measured).otherwise(F.raise_error(F.lit("lengths must be positive")).cast("double"))


def apply_metric_scale(m: Column, metres: Column) -> Column:
    """A similarity with its scale replaced: metres times (R p + t), R and t without the scale it had."""
    now = uniform_scale(m)
    by = F.when(metres > 0, metres).otherwise(F.raise_error(F.lit("metres of a unit must be positive")).cast("double"))
    terms = [F.get(m, F.lit(4 * i + j)) / now * by for i in range(3) for j in range(4)]
    return F.array(*terms, *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])


def measured_length(p: Vector, q: Vector, m: Column) -> Column:
    """The distance of two picked points after a transform."""
    return norm([a - b for a, b in zip(apply_transform(p, m), apply_transform(q, m), strict=True)])


def render_camera_pose(c2w: Column, m: Column) -> Column:
    """A camera-to-world pose in another frame with y and z turned round, its axes at length 1 again."""
    moved = matmul44(m, c2w)
    axes = [[F.get(moved, F.lit(4 * row + k)) * sign for row in range(3)] for k, sign in ((0, 1.0), (1, -1.0), (2, -1.0))]
    unit = [[c / F.greatest(norm(a), F.lit(1e-12)) for c in a] for a in axes]
    return matrix_of([unit[k][row] for row in range(3) for k in range(3)], [F.get(moved, F.lit(4 * row + 3)) for row in range(3)])


def obb_corner(centre: Vector, r: Vector, half: Vector, k: Column) -> list[Column]:
    """Corner k (0 to 7, its bits choose the side on each axis) of a box turned by r."""
    ends = [F.when(k.bitwiseAND(1 << axis) == 0, -half[axis]).otherwise(half[axis]) for axis in range(3)]
    return [a + b for a, b in zip(centre, rotate(r, ends), strict=True)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Sweeps of rotations after which a 3x3 matrix is diagonal in double precision.
SWEEPS = 8


def eigh3(matrix: Sequence[Column]) -> Column:
    """Eigenvalues and eigenvectors of a symmetric 3x3 matrix, given as xx, yy, zz, xy, xz, yz: an array of three structs (value, vector),
    ascending. Vectors have length 1 and their component of largest magnitude is positive. Null where an entry is null.

    Jacobi's method: each sweep turns the planes xy, xz and yz so that their entry vanishes; a fixed number of sweeps.
    """
    off = {(0, 1): 3, (0, 2): 4, (1, 2): 5}

    def turn(p: int, q: int) -> Callable[[Column], Column]:
        r = 3 - p - q

        def entry(state: Column, i: int, j: int) -> Column:
            return F.get(state, F.lit(i if i == j else off[min(i, j), max(i, j)]))

        def vector(state: Column, k: int, c: int) -> Column:
            return F.get(state, F.lit(6 + 3 * k + c))

        def turned(state: Column) -> Column:
            apq = entry(state, p, q)
            theta = (entry(state, q, q) - entry(state, p, p)) / (2 * F.when(apq != 0, apq).otherwise(1.0))
            tangent = F.when(apq == 0, 0.0).otherwise(F.when(theta < 0, -1.0).otherwise(1.0) / (F.abs(theta) + F.sqrt(theta * theta + 1)))
            return let(tangent, lambda t: let(1 / F.sqrt(t * t + 1), lambda c: moved(state, t, c, t * c)))

        def moved(state: Column, t: Column, c: Column, s: Column) -> Column:
            apq = entry(state, p, q)
            new = {p: entry(state, p, p) - t * apq, q: entry(state, q, q) + t * apq, r: entry(state, r, r), off[p, q]: F.lit(0.0)}
            new[off[min(p, r), max(p, r)]] = c * entry(state, p, r) - s * entry(state, q, r)
            new[off[min(q, r), max(q, r)]] = s * entry(state, p, r) + c * entry(state, q, r)
            for k in range(3):
                new[6 + 3 * p + k] = c * vector(state, p, k) - s * vector(state, q, k)
                new[6 + 3 * q + k] = s * vector(state, p, k) + c * vector(state, q, k)
                new[6 + 3 * r + k] = vector(state, r, k)
            return F.array(*[new[k] for k in range(15)])

        return turned

    def sweep(state: Column, _: Column) -> Column:
        for p, q in off:
            state = let(state, turn(p, q))
        return state

    def signed(state: Column, k: int) -> Column:
        axis = [F.get(state, F.lit(6 + 3 * k + c)) for c in range(3)]
        most = F.greatest(*[F.abs(x) for x in axis])
        sign = F.when(F.coalesce(*[F.when(F.abs(x) == most, x) for x in axis]) < 0, -1.0).otherwise(1.0)
        return F.struct(F.get(state, F.lit(k)).alias("value"), F.array(*[x * sign for x in axis]).alias("vector"))

    start = F.array(*[m.cast("double") for m in matrix], *[F.lit(float(k % 4 == 0)) for k in range(9)])
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(SWEEPS)), start, sweep)
    found = let(solved, lambda state: F.array_sort(F.array(*[signed(state, k) for k in range(3)])))
    known = reduce(and_, [m.isNotNull() for m in matrix])
    return F.when(known, found)
