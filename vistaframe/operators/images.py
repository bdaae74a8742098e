"""Image operators: one image or pair is one row, read and computed in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.sources.tables import ship

# Fixed values of structural similarity: window, spread, and the two constants on a scale of 1.
WINDOW, SIGMA, C1, C2 = 11, 1.5, 0.01**2, 0.03**2


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """path, height, width and data (bytes as red, green, blue) of the images under a folder."""
    ship(spark)
    images = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(path).select("image.*")

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            data = []
            for raw, channels, h, w in zip(b["data"], b["nChannels"], b["height"], b["width"], strict=True):
                pixels = np.frombuffer(raw, np.uint8).reshape(h, w, channels)
                data.append(np.ascontiguousarray(pixels[:, :, 2::-1] if channels >= 3 else np.repeat(pixels, 3, axis=2)).tobytes())
            yield pd.DataFrame({"path": b["origin"], "height": b["height"], "width": b["width"], "data": data})

    return images.mapInPandas(turn, "path string, height int, width int, data binary")


def kernel() -> np.ndarray:
    x = np.arange(WINDOW) - WINDOW // 2
    k = np.exp(-(x**2) / (2 * SIGMA**2))
    return k / k.sum()


def blur(image: np.ndarray) -> np.ndarray:
    """A separable Gaussian; borders are mirrored without the edge itself."""
    pad = WINDOW // 2
    for axis in (0, 1):
        widths = [(0, 0)] * image.ndim
        widths[axis] = (pad, pad)
        wide = np.pad(image, widths, mode="reflect")
        image = sum(w * np.take(wide, range(k, k + image.shape[axis]), axis=axis) for k, w in enumerate(kernel()))
    return image


def ssim(a: np.ndarray, b: np.ndarray) -> float:
    """Mean structural similarity of two images on a scale of 1."""
    ma, mb = blur(a), blur(b)
    va, vb, vab = blur(a * a) - ma * ma, blur(b * b) - mb * mb, blur(a * b) - ma * mb
    return float((((2 * ma * mb + C1) * (2 * vab + C2)) / ((ma * ma + mb * mb + C1) * (va + vb + C2))).mean())


def shrink_to(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """An area average of the image on another grid."""

    def along(x: np.ndarray, n: int) -> np.ndarray:
        size = x.shape[0]
        edges = np.linspace(0, size, n + 1)
        sums = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)])
        low = np.floor(edges).astype(int)
        part = sums[low] + (edges - low).reshape(-1, *[1] * (x.ndim - 1)) * (sums[np.minimum(low + 1, size)] - sums[low])
        return np.diff(part, axis=0) * n / size

    return along(along(image, height).swapaxes(0, 1), width).swapaxes(0, 1)


def view_metrics(references: DataFrame, renders: DataFrame, key: list[str]) -> DataFrame:
    """key, psnr and ssim of images (key, height, width, data) that have a render; a render of another size is averaged to the reference's."""
    ship(references.sparkSession)
    pairs = references.join(renders.select(*key, *[F.col(c).alias(f"_{c}") for c in ("height", "width", "data")]), key)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            psnr, similar = [], []
            for h, w, data, h2, w2, data2 in zip(*(b[c] for c in ("height", "width", "data", "_height", "_width", "_data")), strict=True):
                one = np.frombuffer(data, np.uint8).reshape(h, w, 3) / 255
                two = np.frombuffer(data2, np.uint8).reshape(h2, w2, 3) / 255
                if one.shape != two.shape:
                    two = shrink_to(two, *one.shape[:2])
                mse = float(((one - two) ** 2).mean())
                psnr.append(np.inf if mse <= 1e-12 else 10 * np.log10(1 / mse))
                similar.append(ssim(one, two))
            yield b[key].assign(psnr=psnr, ssim=similar)

    kinds = dict(references.dtypes)
    return pairs.mapInPandas(measure, ", ".join(f"{k} {kinds[k]}" for k in key) + ", psnr double, ssim double")


def sharpness(images: DataFrame, key: list[str]) -> DataFrame:
    """key and the variance of the four-neighbour Laplacian of each image's brightness."""
    ship(images.sparkSession)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for h, w, data in zip(b["height"], b["width"], b["data"], strict=True):
                gray = np.frombuffer(data, np.uint8).reshape(h, w, 3) @ np.array([0.299, 0.587, 0.114])
                wide = np.pad(gray, 1, mode="reflect") if min(h, w) > 1 else np.pad(gray, 1, mode="edge")
                out.append(float((wide[:-2, 1:-1] + wide[2:, 1:-1] + wide[1:-1, :-2] + wide[1:-1, 2:] - 4 * gray).var()))
            yield b[key].assign(sharpness=out)

    kinds = dict(images.dtypes)
    return images.mapInPandas(measure, ", ".join(f"{k} {kinds[k]}" for k in key) + ", sharpness double")


def resized(images: DataFrame, key: list[str], turn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """key, height, width and data of images turned one by one."""
    ship(images.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [turn(np.frombuffer(data, np.uint8).reshape(h, w, -1)) for h, w, data in zip(b["height"], b["width"], b["data"], strict=True)]
            yield b[key].assign(height=[x.shape[0] for x in found], width=[x.shape[1] for x in found], data=[np.ascontiguousarray(x).tobytes() for x in found])

    kinds = dict(images.dtypes)
    return images.mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in key) + ", height int, width int, data binary")


def downscale_images(images: DataFrame, key: list[str], k: int, masks: bool = False) -> DataFrame:
    """Images reduced k times to whole pixels, one at least: by area average, or masks (one channel or more) by their nearest pixel."""

    def turn(image: np.ndarray) -> np.ndarray:
        h, w = max(1, image.shape[0] // k), max(1, image.shape[1] // k)
        if masks:
            at = lambda n, size: ((np.arange(n) + 0.5) * size / n).astype(int)
            return image[at(h, image.shape[0])][:, at(w, image.shape[1])]
        return np.clip(np.rint(shrink_to(image.astype(float), h, w)), 0, 255).astype(np.uint8)

    return resized(images, key, turn)


# Fixed values of de-lighting: gamma, weights of red, green and blue, least illumination, and where the median goes.
GAMMA, LUMINANCE, LEAST_LIGHT, MEDIAN = 2.2, (0.2126, 0.7152, 0.0722), 0.05, 0.5


def smoothed(plane: np.ndarray, sigma: float) -> np.ndarray:
    """A separable Gaussian of any width; borders are mirrored without the edge itself."""
    reach = max(1, int(np.ceil(4 * sigma)))
    weights = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    weights /= weights.sum()
    for axis in (0, 1):
        n = plane.shape[axis]
        period = max(1, 2 * (n - 1))
        at = np.abs((np.arange(-reach, n + reach) + n - 1) % period - (n - 1)) if n > 1 else np.zeros(n + 2 * reach, int)
        wide = np.take(plane, at, axis=axis)
        plane = np.apply_along_axis(np.convolve, axis, wide, weights, mode="valid")
    return plane


def delight(images: DataFrame, key: list[str]) -> DataFrame:
    """Textures without their large-scale light: linear values over the blurred luminance, the median brought to the middle."""

    def turn(image: np.ndarray) -> np.ndarray:
        linear = (image.astype(float) / 255) ** GAMMA
        light = smoothed(np.maximum(linear @ np.array(LUMINANCE), 1e-4), max(3.0, min(image.shape[:2]) / 32))
        flat = linear / np.maximum(light, LEAST_LIGHT)[:, :, None]
        flat = np.clip(flat * (MEDIAN / max(float(np.median(flat)), 1e-3)), 0, 1)
        return np.rint(flat ** (1 / GAMMA) * 255).astype(np.uint8)

    return resized(images, key, turn)
