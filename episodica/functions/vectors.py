"""Column functions on vectors (arrays of numbers): reshaping, scaling, geometry."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Range = tuple[int, int]


def part(v: Column, start: int, end: int) -> Column:
    """v[start:end], zero-based."""
    return F.slice(v, start + 1, end - start)


def permute(v: Column, ranges: Sequence[Range]) -> Column:
    """The given ranges of v, one after the other."""
    return F.concat(*(part(v, a, b) for a, b in ranges))


def inverse_ranges(ranges: Sequence[Range]) -> list[Range]:
    """Ranges that undo ``permute`` of ranges which cover a vector once."""
    at, out = 0, []
    for a, b in ranges:
        out.append((a, (at, at + b - a)))
        at += b - a
    return [r for _, r in sorted(out)]


def range_indices(ranges: Sequence[Range]) -> list[int]:
    """All positions of some ranges."""
    return [i for a, b in ranges for i in range(a, b)]


def pick(v: Column, indices: Sequence[int]) -> Column:
    """Elements at zero-based positions; null where v is shorter."""
    return F.array(*(F.get(v, F.lit(i)) for i in indices))


def pad(v: Column, size: int, value: float = 0.0) -> Column:
    """Filled on the right to ``size``; longer vectors stay."""
    return F.concat(v, F.array_repeat(F.lit(value), F.greatest(F.lit(0), F.lit(size) - F.size(v))))


def run_mask(*runs: int) -> list[bool]:
    """Signed run lengths to booleans: positive runs are true, negative false."""
    return [n > 0 for n in runs for _ in range(abs(n))]


def shift(rows: Column, state: Column, mask: Sequence[bool] | None, sign: int) -> Column:
    """Add (1) or take away (-1) state to each row, where the mask is true; other dimensions stay."""
    if mask is None:
        return rows
    on = F.array(*map(F.lit, mask))
    moved = lambda row: F.transform(row, lambda x, i: F.when(F.coalesce(F.get(on, i), F.lit(False)), x + sign * F.get(state, i)).otherwise(x))
    return F.transform(rows, moved)


def every(v: Column, step: int) -> Column:
    """Every step-th element, the first included."""
    return F.filter(v, lambda x, i: i % step == 0)


def _with(v: Column, others: Sequence[Column], f) -> Column:  # noqa: ANN001
    return F.transform(v, lambda x, i: f(x, *(F.get(o, i) for o in others)))


def zscore(v: Column, mean: Column, std: Column) -> Column:
    return _with(v, (mean, std), lambda x, m, s: (x - m) / (s + 1e-6))


def unzscore(v: Column, mean: Column, std: Column) -> Column:
    return _with(v, (mean, std), lambda x, m, s: x * (s + 1e-6) + m)


def to_quantiles(v: Column, low: Column, high: Column) -> Column:
    """[low, high] to [-1, 1], beyond them further on."""
    return _with(v, (low, high), lambda x, a, b: (x - a) / (b - a + 1e-6) * 2 - 1)


def from_quantiles(v: Column, low: Column, high: Column) -> Column:
    return _with(v, (low, high), lambda x, a, b: (x + 1) / 2 * (b - a + 1e-6) + a)


def scale(v: Column, offset: Column, factor: Column) -> Column:
    return _with(v, (offset, factor), lambda x, o, f: (x - o) / f)


def unscale(v: Column, offset: Column, factor: Column) -> Column:
    return _with(v, (offset, factor), lambda x, o, f: x * f + o)


def clipped(x: Column, low: Column, high: Column) -> Column:
    """Scaled to [-1, 1] and cut there."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (x - low) / (high - low + 1e-8) - 1))


def floor_std(std: Column, least: float = 1e-2) -> Column:
    """Deviations too small to divide by become one."""
    return F.transform(std, lambda s: F.when(s < least, F.lit(1.0)).otherwise(s))


def digitize(x: Column, bins: int = 256) -> Column:
    """The bin of x among equal ones over [-1, 1): -1 below, the last at and above the end."""
    return F.greatest(F.lit(-1), F.least(F.lit(bins - 1), F.floor((x + 1) * (bins / 2)))).cast("long")


def minmax(x: Column, low: Column, high: Column) -> Column:
    return (x - low) / (high - low)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-10))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def on_line(p: Column, a: Column, b: Column, clamp: bool = False) -> Column:
    """The foot of p on the line from a to b, or on the segment."""
    t = dot(minus(p, a), minus(b, a)) / dot(minus(b, a), minus(b, a))
    if clamp:
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.zip_with(a, b, lambda x, y: x + t * (y - x))


def one_hot(i: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: (j == i).cast("double"))


def pad_rows(rows: Column, before: int, after: int, same: bool, value: float = 0.0) -> Column:
    """Rows repeated at either end (``same``), or constants there."""
    first, last = (F.element_at(rows, 1), F.element_at(rows, -1)) if same else (F.lit(value), F.lit(value))
    return F.concat(F.array_repeat(first, before), rows, F.array_repeat(last, after))


def project(point: Column, camera: Column, rotation: Sequence[Column], fovy: float, height: int, width: int) -> tuple[Column, Column]:
    """Pixel column and row of a world point in a pinhole camera that looks along its negative z; null behind it.

    ``rotation`` holds the camera's three axes in world coordinates.
    """
    import math

    d = minus(point, camera)
    x, y, z = (dot(d, axis) for axis in rotation)
    focal = 0.5 * height / math.tan(math.radians(fovy) / 2)
    seen = z < 0
    u = F.when(seen, (focal * x / -z + width / 2).cast("long"))
    v = F.when(seen, (height / 2 - focal * y / -z).cast("long"))
    return u, v


def flip_box(box: Column, width: int, height: int) -> Column:
    """A box (x1, y1, x2, y2) turned by 180 degrees."""
    x1, y1, x2, y2 = (F.element_at(box, i) for i in (1, 2, 3, 4))
    return F.array(width - 1 - x2, height - 1 - y2, width - 1 - x1, height - 1 - y1)


def box_centre(box: Column) -> Column:
    """Whole-numbered centre, null for a null box."""
    x1, y1, x2, y2 = (F.element_at(box, i) for i in (1, 2, 3, 4))
    return F.when(box.isNotNull(), F.array(((x1 + x2) / 2).cast("long"), ((y1 + y2) / 2).cast("long")))


def resized(x: Column, size: int, original: int = 256) -> Column:
    """A pixel position carried to an image of another size, cut to whole numbers."""
    return (x * size / original).cast("long")


def inside(p: Column, p0: Column, axes: Sequence[tuple[Column, Column]], margin: float = 0.0) -> Column:
    """Whether p lies between p0 and the far corner along each axis (unit vector, far corner)."""
    out = F.lit(True)
    for u, far in axes:
        out = out & (dot(u, p0) - margin <= dot(u, p)) & (dot(u, p) <= dot(u, far) + margin)
    return out


def corners(centre: Column, half: Column) -> Column:
    """The eight corners of an upright box."""
    def corner(signs: tuple[float, ...]) -> Column:
        sign = F.array(*map(F.lit, signs))
        return F.transform(centre, lambda x, i: x + F.get(sign, i) * F.get(half, i))

    return F.array(*(corner((a, b, c)) for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)))


def separated(a: Column, b: Column, axes: Sequence[Column]) -> Column:
    """Whether some axis parts two sets of points: separating-axis test."""
    out = F.lit(False)
    for axis in axes:
        pa, pb = (F.transform(s, lambda p: dot(p, axis)) for s in (a, b))
        out = out | (F.array_max(pa) < F.array_min(pb)) | (F.array_max(pb) < F.array_min(pa))
    return out


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x worked out once: nested formulas would repeat it without end."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def quaternion_of(axis_angle: Column) -> Column:
    """Real part first; a series below 1e-6."""
    def scaled(v: Column, angle: Column) -> Column:
        factor = F.when(angle < 1e-6, F.lit(0.5) - angle * angle / 48).otherwise(F.sin(angle / 2) / angle)
        return F.concat(F.array(F.cos(angle / 2)), let(factor, lambda k: F.transform(v, lambda x: x * k)))

    return let(axis_angle, lambda v: let(norm(v), lambda angle: scaled(v, angle)))


def matrix_of(q: Column) -> Column:
    """Nine elements, by rows, of the rotation of a quaternion (real part first)."""

    def rows(q: Column, s: Column) -> Column:
        w, x, y, z = (F.element_at(q, i) for i in (1, 2, 3, 4))
        return F.array(1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w), s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w), s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y))

    return let(q, lambda q: let(2.0 / dot(q, q), lambda s: rows(q, s)))


def six_of(axis_angle: Column) -> Column:
    """The first two rows of the rotation matrix."""
    return F.slice(matrix_of(quaternion_of(axis_angle)), 1, 6)


def matrix_of_six(six: Column) -> Column:
    """The rotation whose first two rows span the given ones (Gram-Schmidt)."""
    unit = lambda v: let(norm(v), lambda n: F.transform(v, lambda e: e / n))
    across = lambda b, x: let(dot(x, b), lambda d: unit(F.zip_with(b, x, lambda v, u: v - d * u)))
    g = lambda v, i: F.element_at(v, i)

    def rows(x: Column, y: Column) -> Column:
        return F.concat(x, y, F.array(g(x, 2) * g(y, 3) - g(x, 3) * g(y, 2), g(x, 3) * g(y, 1) - g(x, 1) * g(y, 3), g(x, 1) * g(y, 2) - g(x, 2) * g(y, 1)))

    return let(six, lambda s: let(unit(F.slice(s, 1, 3)), lambda x: let(across(F.slice(s, 4, 3), x), lambda y: rows(x, y))))


def yaw_of(q: Column) -> Column:
    """Rotation about z of a quaternion (real part first)."""
    w, x, y, z = (F.element_at(q, i) for i in (1, 2, 3, 4))
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def to_local(x: Column, y: Column, turn: Column) -> tuple[Column, Column]:
    """Plane coordinates in a frame turned by ``turn``."""
    return F.cos(turn) * x + F.sin(turn) * y, -F.sin(turn) * x + F.cos(turn) * y


def fit_within(width: Column, height: Column, to_width: int, to_height: int) -> tuple[Column, Column, Column, Column]:
    """Size of an image scaled into a frame with its proportions, and the padding left and above."""
    ratio = F.greatest(width / to_width, height / to_height)
    w, h = (width / ratio).cast("long"), (height / ratio).cast("long")
    return w, h, F.floor((to_width - w) / 2).cast("long"), F.floor((to_height - h) / 2).cast("long")


def quaternion_of_matrix(m: Column) -> Column:
    """Real part first, not negative, of a rotation matrix of nine elements."""
    r = [F.element_at(m, i) for i in range(1, 10)]
    half = lambda x: F.sqrt(F.greatest(F.lit(0.0), x)) / 2
    w, x, y, z = half(1 + r[0] + r[4] + r[8]), half(1 + r[0] - r[4] - r[8]), half(1 - r[0] + r[4] - r[8]), half(1 - r[0] - r[4] + r[8])
    # signs by the greatest component, which cannot be 0
    by_w = F.array(w, (r[7] - r[5]) / (4 * w), (r[2] - r[6]) / (4 * w), (r[3] - r[1]) / (4 * w))
    by_x = F.array((r[7] - r[5]) / (4 * x), x, (r[1] + r[3]) / (4 * x), (r[2] + r[6]) / (4 * x))
    by_y = F.array((r[2] - r[6]) / (4 * y), (r[1] + r[3]) / (4 * y), y, (r[5] + r[7]) / (4 * y))
    by_z = F.array((r[3] - r[1]) / (4 * z), (r[2] + r[6]) / (4 * z), (r[5] + r[7]) / (4 * z), z)
    most = F.greatest(w, x, y, z)
    picked = F.when(w == most, by_w).when(x == most, by_x).when(y == most, by_y).otherwise(by_z)
    return let(picked, lambda q: F.when(F.element_at(q, 1) < 0, F.transform(q, lambda e: -e)).otherwise(q))


def axis_angle_of(q: Column) -> Column:
    """Of a quaternion, real part first; a series below 1e-6."""

    def scaled(q: Column, n: Column) -> Column:
        angle = 2 * F.atan2(n, F.element_at(q, 1))
        factor = F.when(F.abs(angle) < 1e-6, F.lit(2.0)).otherwise(angle / n)
        return let(factor, lambda k: F.transform(F.slice(q, 2, 3), lambda e: e * k))

    return let(q, lambda q: let(norm(F.slice(q, 2, 3)), lambda n: scaled(q, n)))


def matrix_of_euler(a: Column) -> Column:
    """Rotation by three angles about x, then y, then z."""
    (cx, sx), (cy, sy), (cz, sz) = ((F.cos(F.element_at(a, i)), F.sin(F.element_at(a, i))) for i in (1, 2, 3))
    return F.array(cz * cy, cz * sy * sx - sz * cx, cz * sy * cx + sz * sx, sz * cy, sz * sy * sx + cz * cx, sz * sy * cx - cz * sx, -sy, cy * sx, cy * cx)


def euler_of_matrix(m: Column) -> Column:
    """The angles about x, y and z; the middle one lies within a right angle."""
    g = lambda i: F.element_at(m, i)
    return F.array(F.atan2(g(8), g(9)), F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -g(7)))), F.atan2(g(4), g(1)))


def relative(a_pos: Column, a_mat: Column, b_pos: Column, b_mat: Column) -> tuple[Column, Column]:
    """Position and rotation of b as seen from a."""
    row = lambda m, i: F.array(*(F.element_at(m, 3 * j + i + 1) for j in range(3)))  # noqa: E731  of the transposed matrix
    d = minus(b_pos, a_pos)
    pos = F.array(*(dot(row(a_mat, i), d) for i in range(3)))
    return pos, F.array(*(dot(row(a_mat, i), row(b_mat, j)) for i in range(3) for j in range(3)))
