"""Files our tests write themselves."""

from __future__ import annotations

import numpy as np


def card(key: str, value) -> bytes:
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, str):
        text = "'" + value.replace("'", "''").ljust(8) + "'"
    else:
        text = f"{value!r:>20}"
    return f"{key:<8}= {text}".ljust(80).encode()


def header(cards: dict) -> bytes:
    data = b"".join(card(k, v) for k, v in cards.items()) + b"END".ljust(80)
    return data.ljust(-(-len(data) // 2880) * 2880)


def image(pixels: np.ndarray, **cards) -> bytes:
    """Unsigned 16-bit image; ``pixels`` has axis 0 = x, axis 1 = y."""
    nx, ny = pixels.shape
    head = {"XTENSION": "IMAGE", "BITPIX": 16, "NAXIS": 2, "NAXIS1": nx, "NAXIS2": ny, "PCOUNT": 0, "GCOUNT": 1,
            "BSCALE": 1, "BZERO": 32768, **cards}
    raw = (pixels.T.astype(np.int64) - 32768).astype(">i2").tobytes()
    return header(head) + raw.ljust(-(-len(raw) // 2880) * 2880, b"\0")


def fits_file(images: list[bytes], **cards) -> bytes:
    return header({"SIMPLE": True, "BITPIX": 8, "NAXIS": 0, **cards}) + b"".join(images)
