import struct
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import SparkSession

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("featureflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def png_bytes(block: np.ndarray) -> bytes:
    """Encode an h x w, h x w x 3 or h x w x 4 uint8 array."""
    block = np.ascontiguousarray(block, dtype=np.uint8)
    height, width = block.shape[:2]
    channels = 1 if block.ndim == 2 else block.shape[2]
    colour = {1: 0, 3: 2, 4: 6}[channels]
    raw = b"".join(b"\0" + row.tobytes() for row in block.reshape(height, width * channels))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def picture(seed: int, height: int = 40, width: int = 40, channels: int = 3) -> np.ndarray:
    shape = (height, width) if channels == 1 else (height, width, channels)
    return np.random.default_rng(seed).integers(0, 256, shape, dtype=np.uint8)


@pytest.fixture(scope="session")
def image_set(tmp_path_factory):
    """Class-directory images with awkward names and broken files; returns (root, {relative path: array or None})."""
    root = tmp_path_factory.mktemp("images")
    good = {
        "Apple Red/a 1.png": picture(1),
        "Apple Red/b+2.PNG": picture(2, 32, 32),
        "Banana/c%3.png": picture(3, 60, 50),
        "Banana/d%20.png": picture(4, channels=1),
        "Banana/é.png": picture(5, channels=4),
        "Tiny/small.png": picture(6, 8, 8),
        "Tiny/narrow.png": picture(7, 100, 31),
    }
    for name, block in good.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(png_bytes(block))
    (root / "Banana/broken.png").write_bytes(b"not an image")
    (root / "Banana/cut.png").write_bytes(png_bytes(picture(8, 64, 64))[:300])
    (root / "Banana/empty.png").write_bytes(b"")
    (root / "Banana/notes.txt").write_text("x")
    (root / "stray.png").write_bytes(png_bytes(picture(9)))
    (root / "Banana/deep").mkdir()
    (root / "Banana/deep/nested.png").write_bytes(png_bytes(picture(10)))
    return str(root), good
