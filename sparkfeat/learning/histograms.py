"""What the tasks of boosted trees do: packed cells, sums of gradients, best splits, held-out scores by range.

A block is a dictionary of arrays over some cells: ``label``, ``fold`` (-1 for none), ``n``, ``codes``
(feature, cell), ``draws`` (one bit per tree) and ``margins`` (model, cell). A tree is a dictionary
``node: (feature, code, missing_left, left, right)`` with the array of its nodes' values.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING = -1
#: Cells of a block, and codes in it, at most.
BLOCK = 100_000
BLOCK_CODES = 8_000_000
#: Bytes of sums that a task holds; more are given out block by block.
HELD = 64 << 20
#: Scores that a task names for the cuts between ranges.
POINTS = 64
#: Whole numbers below are exact as doubles, whatever the order they are added in.
EXACT = float(1 << 52)

Block = dict[str, Any]
Splits = Mapping[int, tuple[int, int, bool, int, int]]
Walk = tuple[Splits, np.ndarray]


def packing(width: int, bases: Sequence[float]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over ``label, fold, n, codes`` and, where rows are drawn, ``draws``: one pickled block per row."""
    most = max(1, min(BLOCK, BLOCK_CODES // max(width, 1)))

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        label = rows["label"].to_numpy().astype(np.float64)
        if np.isnan(label).any():
            raise ValueError("labels are numbers or null, not NaN")
        codes = rows["codes"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(label), width)
        out = {
            "label": label,
            "fold": rows["fold"].fill_null(-1).to_numpy().astype(np.int32),
            "n": rows["n"].to_numpy().astype(np.int64),
            "codes": np.ascontiguousarray(codes.T.astype(np.int16)),
            "draws": rows["draws"].to_numpy().astype(np.int64) if "draws" in rows.column_names else None,
            "margins": np.repeat(np.array(bases, float)[:, None], len(label), axis=1),
        }
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(out, 5)], pa.binary())], names=["block"])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                if size + part.num_rows > most:
                    yield block(parts)
                    parts, size = [], 0
                parts.append(part)
                size += part.num_rows
        if size:
            yield block(parts)

    return pack


def leaves(codes: np.ndarray, splits: Splits, n: int) -> np.ndarray:
    """The node that each cell's codes lead to."""
    out = np.zeros(n, np.int32)
    ways: list[tuple[int, np.ndarray]] = [(0, np.arange(n))] if splits else []
    while ways:
        node, at = ways.pop()
        if node not in splits:
            out[at] = node
            continue
        feature, code, missing_left, left, right = splits[node]
        x = codes[feature][at]
        turn = x <= code if missing_left else (x <= code) & (x != MISSING)
        ways += [(left, at[turn]), (right, at[~turn])]
    return out


def margin_after(codes: np.ndarray, margin: np.ndarray, trees: Sequence[Walk]) -> np.ndarray:
    for splits, values in trees:
        margin = margin + values[leaves(codes, splits, len(margin))]
    return margin


def with_trees(block: Block, trees: Sequence[Sequence[Walk]]) -> Block:
    """The block with the values of each model's ``trees`` in its margins."""
    return {**block, "margins": np.stack([margin_after(block["codes"], m, t) for m, t in zip(block["margins"], trees)])}


def unpacking(trees: Sequence[Sequence[Walk]]) -> Callable[[Sequence[bytes]], Block]:
    """For ``map``: the block of a row, with the values of ``trees``."""
    return lambda row: with_trees(pickle.loads(row[0]), trees)


def adding(trees: Sequence[Sequence[Walk]]) -> Callable[[Block], Block]:
    return lambda block: with_trees(block, trees)


def scoring(width: int, bases: Sequence[float], trees: Sequence[Sequence[Walk]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over ``codes``: them, and the margin of every model."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            codes = np.ascontiguousarray(batch.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(n, width).T)
            margins = np.stack([margin_after(codes, np.full(n, float(base)), own) for base, own in zip(bases, trees)], axis=1)
            ends = np.arange(n + 1, dtype=np.int32) * len(bases)
            yield pa.RecordBatch.from_arrays([batch.column("codes"), pa.ListArray.from_arrays(pa.array(ends), pa.array(margins.ravel()))], names=["codes", "margins"])

    return score


def _whole(x: np.ndarray) -> np.ndarray:
    """Rounded, halves away from zero."""
    size = np.abs(x)
    low = np.trunc(size)
    return (np.sign(x) * (low + (size - low >= 0.5))).astype(np.int64)


def _summed(at: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    if np.abs(x).sum(dtype=float) < EXACT:
        return np.bincount(at, x, size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, at, x)
    return out


def gradients(block: Block, margin: np.ndarray, weight: float, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second order, in whole units, of all rows of each cell."""
    y, n = block["label"], block["n"]
    with np.errstate(over="ignore"):
        p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y > 0, weight, 1.0)
    return _whole((p - y) * w * unit) * n, _whole(p * (1.0 - p) * w * unit) * n


def summing(
    trees: Sequence[Sequence[Walk]], growing: Mapping[int, tuple[Splits, Sequence[int]]], drawn: Sequence[int], widths: Sequence[int],
    weights: Sequence[float], unit: int, bit: int | None,
) -> Callable[[Iterable[Block]], Iterator[tuple[int, np.ndarray]]]:
    """For ``mapPartitions``: ``(model * len(drawn) + place, sums)``, the sums being (node, g h n, code + 1).

    ``growing`` has each model's unfinished tree and the nodes in question; model ``j`` sees
    the cells whose fold is not ``j``. ``bit`` is the tree's place in ``draws``.
    """
    size = sum(len(nodes) for _, nodes in growing.values()) * sum(widths[f] for f in drawn) * 3 * 8

    def sums(blocks: Iterable[Block]) -> Iterator[tuple[int, np.ndarray]]:
        held: dict[int, np.ndarray] = {}
        for block in blocks:
            for j, (splits, nodes) in growing.items():
                seen = block["fold"] != j
                if bit is not None:
                    seen &= (block["draws"] >> bit) & 1 == 1
                place = np.full(max([*nodes, *[c for s in splits.values() for c in s[3:]]]) + 1, -1)
                place[list(nodes)] = np.arange(len(nodes))
                node = place[leaves(block["codes"], splits, len(seen))]
                use = np.flatnonzero(seen & (node >= 0))
                if not len(use):
                    continue
                part = {x: block[x][use] for x in ("label", "n")}
                codes = block["codes"][:, use]
                g, h = gradients(part, margin_after(codes, block["margins"][j][use], trees[j]), weights[j], unit)
                node = node[use]
                for at, f in enumerate(drawn):
                    cell = node * widths[f] + codes[f] + 1
                    found = np.stack([_summed(cell, x, len(nodes) * widths[f]).reshape(len(nodes), -1) for x in (g, h, part["n"])], axis=1)
                    key = j * len(drawn) + at
                    if size > HELD:
                        yield key, found
                    elif key in held:
                        held[key] += found
                    else:
                        held[key] = found
        yield from held.items()

    return sums


def best_of_feature(sums: np.ndarray, feature: int, s: Any, unit: int) -> list[dict[str, Any] | None]:
    """Of each node: its sums and the best split by one feature, if any is allowed; nothing for a node without rows.

    A split sends codes up to its own to the left; missing cells go to the side where the gain
    is larger. Ties: the smaller code, then missing cells to the right.
    """
    out: list[dict[str, Any] | None] = []
    score = lambda g, h: _over(np.maximum(np.abs(g) - s.l1, 0.0) ** 2, h + s.l2)
    for node in sums:
        total = node.sum(axis=1)
        g, h, n = total[0] / unit, total[1] / unit, int(total[2])
        if not n:
            out.append(None)
            continue
        found = {"gain": None, "g": float(g), "h": float(h), "n": n}
        upto, met = np.cumsum(node[:, 1:], axis=1), node[2, 1:] > 0
        for missing_left in (0, 1) if node[2, 0] else (0,):
            gl, hl, nl = upto + node[:, :1] if missing_left else upto
            gl, hl = gl / unit, hl / unit
            gr, hr, nr = g - gl, h - hl, n - nl
            gain = score(gl, hl) + score(gr, hr) - score(g, h)
            least = max(s.least_rows, 1)
            allowed = met & (gain > max(s.least_gain, 1e-12)) & (nl >= least) & (nr >= least) & (hl >= s.least_hessian) & (hr >= s.least_hessian)
            if not allowed.any():
                continue
            at = int(np.argmax(np.where(allowed, gain, -np.inf)))
            rank = (float(gain[at]), -feature, -at, 1 - missing_left)
            if found["gain"] is None or rank > _rank(found):
                found |= {"gain": rank[0], "feature": feature, "code": at, "missing_left": missing_left, "gl": float(gl[at]), "hl": float(hl[at]), "nl": int(nl[at])}
        out.append(found)
    return out


def _over(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.divide(x, y, out=np.zeros(np.shape(x)), where=np.asarray(y) != 0)


def _rank(r: Mapping[str, Any]) -> tuple:
    return r["gain"], -r["feature"], -r["code"], 1 - r["missing_left"]


def best_of(features: Iterable[tuple[int, np.ndarray]], asked: Mapping[int, Sequence[int]], drawn: Sequence[int], s: Any, unit: int) -> dict[tuple[int, int], dict[str, Any]]:
    """The best split of each (model, node) by the features whose whole sums are given."""
    out: dict[tuple[int, int], dict[str, Any]] = {}
    for key, sums in features:
        j, at = divmod(key, len(drawn))
        better(out, {(j, node): r for node, r in zip(asked[j], best_of_feature(sums, drawn[at], s, unit)) if r})
    return out


def searching(
    asked: Mapping[int, Sequence[int]], drawn: Sequence[int], s: Any, unit: int
) -> Callable[[Iterable[tuple[int, np.ndarray]]], list[dict[tuple[int, int], dict[str, Any]]]]:
    """For ``mapPartitions`` over whole sums."""
    return lambda features: [best_of(features, asked, drawn, s, unit)]


def better(out: dict[tuple[int, int], dict[str, Any]], other: Mapping[tuple[int, int], dict[str, Any]]) -> None:
    for key, r in other.items():
        if key not in out or r["gain"] is not None and (out[key]["gain"] is None or _rank(r) > _rank(out[key])):
            out[key] = r


def held_out(block: Block, trees: Sequence[Sequence[Walk]], last: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(model, place, cells, scores)``: the margins of a model's own fold after each of the ``last`` trees."""
    for j, own in enumerate(trees):
        use = np.flatnonzero(block["fold"] == j)
        codes, margin = block["codes"][:, use], block["margins"][j][use]
        margin = margin_after(codes, margin, own[: len(own) - last])
        for at, tree in enumerate(own[len(own) - last :]):
            margin = margin_after(codes, margin, [tree])
            yield j, at, use, margin


def points(trees: Sequence[Sequence[Walk]]) -> Callable[[Iterable[Block]], Iterator[np.ndarray]]:
    """For ``mapPartitions``: some scores of the last trees, evenly by rank."""

    def name(blocks: Iterable[Block]) -> Iterator[np.ndarray]:
        scores = [x for b in blocks for _, _, _, x in held_out(b, trees, 1)]
        found = np.sort(np.concatenate(scores)) if scores else np.zeros(0)
        if len(found):
            yield found[np.linspace(0, len(found) - 1, POINTS).astype(int)]

    return name


def _collapsed(scores: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, at = np.unique(scores, return_inverse=True)
    return values, np.bincount(at, pos, len(values)), np.bincount(at, neg, len(values))


def _joined(parts: Sequence[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _collapsed(*[np.concatenate(x) for x in zip(*parts)])


def ranging(trees: Sequence[Sequence[Walk]], last: int, cuts: np.ndarray) -> Callable[[Iterable[Block]], Iterator[tuple[int, tuple[np.ndarray, ...]]]]:
    """For ``mapPartitions``: ``((model * last + place) * ranges + range, (scores, positives, negatives))``, equal scores being one."""

    def deal(blocks: Iterable[Block]) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for block in blocks:
            y = block["label"].astype(np.int64)
            pos, neg = (y * block["n"]).astype(float), ((1 - y) * block["n"]).astype(float)
            for j, at, use, scores in held_out(block, trees, last):
                values, up, down = _collapsed(scores, pos[use], neg[use])
                ends = [0, *np.searchsorted(values, cuts), len(values)]
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    if a < b:
                        held.setdefault((j * last + at) * (len(cuts) + 1) + i, []).append((values[a:b], up[a:b], down[a:b]))
        for key, parts in held.items():
            yield key, _joined(parts) if len(parts) > 1 else parts[0]

    return deal


def wins(parts: Iterable[tuple[np.ndarray, ...]]) -> tuple[float, float, float]:
    """Pairs within a range whose positive scores higher, ties counting half; positives; negatives."""
    _, pos, neg = _joined(list(parts))
    lower = np.concatenate([[0.0], np.cumsum(neg)[:-1]])
    return float((pos * (lower + neg / 2)).sum()), float(pos.sum()), float(neg.sum())


def auc_of(ranges: Sequence[tuple[float, float, float]]) -> float | None:
    """Exact area under the curve from what ``wins`` gives for the ranges of one group, from the lowest; None for one class."""
    total = pos = neg = 0.0
    for w, p, n in ranges:
        total += w + p * neg
        pos, neg = pos + p, neg + n
    return total / (pos * neg) if pos * neg else None
