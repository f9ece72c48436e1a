"""A byte-level convolutional network in numpy: byte vectors, filters of several widths, max pooling, one linear layer.

A text becomes windows of fixed length that cover every byte; each gets its class scores. Byte 0 fills short
windows. Filters slide by `stride` bytes: a window is then a row of blocks, and a filter over m blocks is the
sum of m matrix products, with no copy of overlapping input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

#: Windows put through the network at once.
TOGETHER = 192


@dataclass
class Shape:
    length: int
    step: int
    stride: int
    widths: tuple[int, ...]  # in strides
    filters: int
    classes: int
    dims: int = 8


def windows(text: bytes, shape: Shape) -> np.ndarray:
    """All windows of a text, the last one filled up; one for an empty text."""
    rest = max(0, len(text) - shape.length)
    count = 1 + -(-rest // shape.step)
    room = np.zeros((count - 1) * shape.step + shape.length, np.uint8)
    room[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(room, (count, shape.length), (shape.step, 1))


def some_windows(text: bytes, shape: Shape, most: int) -> np.ndarray:
    """At most `most` windows, evenly spread; for training only."""
    every = windows(text, shape)
    return every if len(every) <= most else every[np.linspace(0, len(every) - 1, most).astype(int)]


def new(shape: Shape, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    block = shape.stride * shape.dims
    net = {"bytes": rng.normal(0, 0.5, (256, shape.dims))}
    net["bytes"][0] = 0
    for m in shape.widths:
        net[f"w{m}"] = rng.normal(0, (2 / (m * block)) ** 0.5, (m, block, shape.filters))
        net[f"b{m}"] = np.zeros(shape.filters)
    net["out"] = rng.normal(0, 0.1, (len(shape.widths) * shape.filters, shape.classes))
    net["bias"] = np.zeros(shape.classes)
    return {k: v.astype(np.float32) for k, v in net.items()}


def _blocks(net: dict, x: np.ndarray, shape: Shape) -> np.ndarray:
    return net["bytes"][x].reshape(len(x), shape.length // shape.stride, shape.stride * shape.dims)


def _sums(net: dict, blocks: np.ndarray, m: int) -> np.ndarray:
    places = blocks.shape[1] - m + 1
    flat = blocks.reshape(-1, blocks.shape[2])
    parts = [(flat @ net[f"w{m}"][j]).reshape(blocks.shape[0], blocks.shape[1], -1) for j in range(m)]
    total = parts[0][:, :places]
    for j in range(1, m):
        total = total + parts[j][:, j : j + places]
    return total


def pooled(net: dict, x: np.ndarray, shape: Shape) -> np.ndarray:
    """The strongest answer of every filter in each window."""
    blocks = _blocks(net, x, shape)
    return np.maximum(np.concatenate([_sums(net, blocks, m).max(axis=1) + net[f"b{m}"] for m in shape.widths], axis=1), 0)


def scores(net: dict, x: np.ndarray, shape: Shape) -> np.ndarray:
    """Class scores (before softmax) of windows."""
    parts = [pooled(net, x[k : k + TOGETHER], shape) @ net["out"] + net["bias"] for k in range(0, len(x), TOGETHER)]
    return np.concatenate(parts) if parts else np.zeros((0, shape.classes), np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _gradient(net: dict, x: np.ndarray, y: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    blocks, rows = _blocks(net, x, shape), np.arange(len(x))[:, None]
    sums = {m: _sums(net, blocks, m) for m in shape.widths}
    best = {m: s.argmax(axis=1) for m, s in sums.items()}
    strongest = np.concatenate([np.take_along_axis(sums[m], best[m][:, None], 1)[:, 0] + net[f"b{m}"] for m in shape.widths], axis=1)
    hidden = np.maximum(strongest, 0)
    error = softmax(hidden @ net["out"] + net["bias"])
    error[np.arange(len(x)), y] -= 1
    error /= len(x)
    grad = {"out": hidden.T @ error, "bias": error.sum(axis=0), "bytes": np.zeros_like(net["bytes"])}
    back = (error @ net["out"].T) * (strongest > 0)
    letters = x.reshape(len(x), -1, shape.stride)
    for k, m in enumerate(shape.widths):
        g, at = back[:, k * shape.filters : (k + 1) * shape.filters], best[m]
        grad[f"b{m}"] = g.sum(axis=0)
        grad[f"w{m}"] = np.stack([np.einsum("nfk,nf->kf", blocks[rows, at + j], g) for j in range(m)])
        for j in range(m):
            down = (g[:, :, None] * net[f"w{m}"][j].T[None]).reshape(-1, shape.dims)
            used = letters[rows, at + j].reshape(-1)
            for d in range(shape.dims):
                grad["bytes"][:, d] += np.bincount(used, down[:, d], 256).astype(np.float32)
    grad["bytes"][0] = 0
    return grad


def train(x: np.ndarray, y: np.ndarray, shape: Shape, epochs: int, batch: int = 64, rate: float = 0.004, seed: int = 1) -> dict[str, np.ndarray]:
    """Adam over shuffled batches; the same input gives the same network."""
    net, rng = new(shape, seed), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in net.items()}
    square = {k: np.zeros_like(v) for k, v in net.items()}
    total, step = epochs * -(-len(x) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), batch):
            step += 1
            pick = order[k : k + batch]
            for name, g in _gradient(net, x[pick], y[pick], shape).items():
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.01 * (g * g - square[name])
                fall = 1 - 0.9 * step / total
                net[name] -= (rate * fall * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def text_scores(net: dict, texts: Iterable[bytes | None], shape: Shape, together: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(mean, lowest) class scores over the windows of each text, in order."""
    held: list[np.ndarray] = []
    size = 0

    def folded():
        nonlocal size
        z = scores(net, np.concatenate(held), shape)
        ends = np.cumsum([len(h) for h in held])
        starts = ends - [len(h) for h in held]
        means = np.add.reduceat(z, starts, axis=0) / (ends - starts)[:, None]
        lows = np.minimum.reduceat(z, starts, axis=0)
        held.clear()
        size = 0
        yield from zip(means, lows)

    for text in texts:
        held.append(windows(text or b"", shape))
        size += len(held[-1])
        if size >= together:
            yield from folded()
    if held:
        yield from folded()
