"""Hashes over the binary forms of a sample's voxels, for parity with stores that keep them.

The text-coded hashes of ``geometry`` compare samples inside the engine; these reproduce fixed binary layouts, little-endian:
the voxel hash covers grid, palette, cells and palette indices; the shape hashes cover cells alone, as they are shifted or under
rotations. Each layout starts with a domain name of the caller's choice and a zero byte.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tessel.operators.geometry import AXES, CUBE, UPRIGHT
from tessel.operators.grids import Tables, by_sample, least_turns

#: Fixed value: cells per axis.
GRID = (256, 256, 256)


def _in_order(cells: np.ndarray) -> np.ndarray:
    return np.lexsort((cells[:, 2], cells[:, 1], cells[:, 0]))


def _shifted(cells: np.ndarray) -> bytes:
    cells = cells - cells.min(axis=0)
    return cells[_in_order(cells)].astype("<i4").tobytes()


def voxel_digest(cells: np.ndarray, states: list[str], domain: str) -> str:
    """Of cells with their states; neither row order nor component names matter."""
    names = sorted(set(states))
    index = {s: i for i, s in enumerate(names)}
    order = _in_order(cells)
    listed = json.dumps(names, ensure_ascii=False, separators=(",", ":")).encode()
    body = [domain.encode() + b"\0", struct.pack("<3HQ", *GRID, len(listed)), listed, struct.pack("<Q", len(cells)), cells[order].astype("<u2").tobytes(), np.array([index[states[i]] for i in order], "<u4").tobytes()]
    return hashlib.sha256(b"".join(body)).hexdigest()


def shape_digest(cells: np.ndarray, domain: str, rotations: list | None = None) -> str:
    """Of the cells alone; under rotations, of the least binary form."""
    forms = [_shifted(cells)] if rotations is None else [_shifted(np.stack([s * cells[:, a] for a, s in r], axis=1)) for r in rotations]
    return hashlib.sha256(domain.encode() + b"\0" + len(cells).to_bytes(8, "little") + min(forms)).hexdigest()


@functools.cache
def _binary_ranks(width: int) -> tuple[np.ndarray, ...]:
    """Ranks of the numbers below ``width`` as little-endian bytes."""
    return (np.argsort(np.argsort(np.arange(width, dtype="<u4").astype(">u4").view("<u4"))),) * 4


def _texts(states: np.ndarray, sample: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Each row's index into its sample's sorted distinct states, and these as JSON, sample by sample."""
    codes, names = pd.factorize(states, use_na_sentinel=False)
    names = [None if pd.isna(n) else n for n in names]
    order = sorted(range(len(names)), key=lambda i: (names[i] is not None, names[i] or ""))
    own = sample * len(names) + np.argsort(order)[codes]
    listed = np.unique(own)
    start = np.flatnonzero(np.diff(listed // len(names), prepend=-1))
    shown = [names[order[i]] for i in (listed % len(names)).tolist()]
    made = [json.dumps(shown[i:j], ensure_ascii=False, separators=(",", ":")).encode() for i, j in zip(start.tolist(), [*start[1:].tolist(), len(shown)], strict=True)]
    return np.searchsorted(listed, own) - start[sample], made


def binary_hashes(voxels: DataFrame, key: str, state: str, voxel_domain: str, shape_domain: str, turned_domain: str, parts: int | None = None) -> DataFrame:
    """(key, voxel_hash, shift_hash, cube_hash, upright_hash) of each sample, as ``voxel_digest`` and ``shape_digest`` give them.

    Samples are treated many at once; a sample's cells are 600,000 at most, a bound that ``canonical_faults`` checks. Rows without
    a sample or a coordinate are no cells; among repeated cells the one of the least state comes first.
    """
    turned = [(shape_domain, [((0, 1), (1, 1), (2, 1))]), (turned_domain, CUBE), (turned_domain, UPRIGHT)]

    def work(t: Tables) -> dict[str, np.ndarray | list]:
        t = t["v"]
        sample = np.unique(t["key"], return_inverse=True)[1]
        index, listed = _texts(t["state"], sample)
        order = np.lexsort((index, t["z"], t["y"], t["x"], sample))
        keys, cells = t["key"][order], np.stack([t[a][order] for a in AXES])
        places, indices = cells.T.astype("<u2").tobytes(), index[order].astype("<u4").tobytes()
        forms = [(domain, *least_turns(keys, cells, rotations, _binary_ranks)) for domain, rotations in turned]
        start = forms[0][2]
        ranges = list(zip(start.tolist(), [*start[1:].tolist(), len(keys)], strict=True))
        made: dict[str, np.ndarray | list] = {"key": keys[start], "voxel_hash": [
            hashlib.sha256(b"".join((voxel_domain.encode(), b"\0", struct.pack("<3HQ", *GRID, len(names)), names, struct.pack("<Q", j - i), places[6 * i : 6 * j], indices[4 * i : 4 * j]))).hexdigest()
            for (i, j), names in zip(ranges, listed, strict=True)]}
        for name, (domain, form, _) in zip(("shift_hash", "cube_hash", "upright_hash"), forms, strict=True):
            content = form.T.astype("<i4").tobytes()
            made[name] = [hashlib.sha256(b"".join((domain.encode(), b"\0", (j - i).to_bytes(8, "little"), content[12 * i : 12 * j]))).hexdigest() for i, j in ranges]
        return made

    rows = voxels.select(F.col(key), *AXES, F.col(state).cast("string").alias("state")).dropna(subset=list(AXES))
    return by_sample(key, {"v": rows}, work, f"key {dict(voxels.dtypes)[key]}, voxel_hash string, shift_hash string, cube_hash string, upright_hash string", parts).withColumnRenamed("key", key)
