"""A bidirectional gated recurrent network over bytes, in numpy.

A text is read in spans of bytes. In each span one unit reads forwards and one backwards, both from
a zero state, and every position gets the probability of every class from the two states there.
Arrays are (step, span, value); spans are in order of falling length, so that those still running
at a step are the first ones. The squashing function is x / (1 + |x|), which costs a fraction of a
hyperbolic tangent; gates are 0.5 + 0.5 of it.
"""

from __future__ import annotations

import numpy as np

SPAN = 64  # bytes
HIDDEN = 8  # values of each direction's state

Weights = dict[str, np.ndarray]


def new_weights(classes: int, hidden: int = HIDDEN, seed: int = 0) -> Weights:
    draw = np.random.default_rng(seed)
    weights = {"bias": np.zeros(classes)}
    for side in ("ahead", "back"):
        weights[f"{side}_bytes"] = draw.normal(scale=0.3, size=(256, 3 * hidden))
        weights[f"{side}_state"] = draw.normal(scale=hidden**-0.5, size=(hidden, 3 * hidden))
        weights[f"{side}_out"] = draw.normal(scale=0.3, size=(hidden, classes))
    return {name: w.astype(np.float32) for name, w in weights.items()}


def spans(data: np.ndarray, offsets: np.ndarray, span: int = SPAN):
    """Spans of all texts of a chunk: their text, start and length, longest first."""
    size = np.diff(offsets)
    parts = -(-size // span)
    text = np.repeat(np.arange(len(size)), parts)
    first = np.cumsum(parts) - parts
    start = (np.arange(len(text)) - np.repeat(first, parts)) * span + np.repeat(offsets[:-1], parts)
    length = np.minimum(span, offsets[text + 1] - start)
    by = np.argsort(-length, kind="stable")
    return text[by], start[by], length[by]


def _read(data: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Bytes by step, forwards and backwards, and how many spans run at each step."""
    steps = np.arange(int(length.max(initial=0)))
    ahead = data[np.minimum(start + steps[:, None], len(data) - 1)]
    back = data[np.maximum(start + length - 1 - steps[:, None], 0)]
    running = np.searchsorted(-length, -steps)  # spans longer than the step
    return ahead, back, running


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(squashed: np.ndarray) -> np.ndarray:
    """Derivative of the squashing function where it has the given value."""
    return np.square(1 - np.abs(squashed))


def _unit(weights: Weights, side: str, read: np.ndarray, running: np.ndarray, trace: list | None = None):
    """States after every step; with ``trace``, what the way back needs is kept there."""
    table, inner = weights[f"{side}_bytes"], weights[f"{side}_state"]
    hidden = inner.shape[0]
    states = np.zeros((len(read), read.shape[1], hidden), table.dtype)
    state = np.zeros((read.shape[1], hidden), table.dtype)
    for step, n in enumerate(running):
        given = table.take(read[step, :n], 0)
        state = state[:n]
        pushed = state @ inner
        gates = _squash(given[:, : 2 * hidden] + pushed[:, : 2 * hidden])
        gates *= 0.5
        gates += 0.5
        keep, reset = gates[:, :hidden], gates[:, hidden:]
        fresh = _squash(given[:, 2 * hidden :] + reset * pushed[:, 2 * hidden :])
        if trace is not None:
            trace.append((state, keep, reset, fresh, pushed[:, 2 * hidden :]))
        state = fresh + keep * (state - fresh)
        states[step, :n] = state
    return states


def _turned(back: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Values by backward step as values by position; positions beyond a span are of no use."""
    out = back[::-1].copy()
    short = np.flatnonzero(length < len(back))
    at = np.maximum(length[short] - 1 - np.arange(len(back))[:, None], 0)
    out[:, short] = back[at, short]
    return out


def _probabilities(weights: Weights, ahead: np.ndarray, back: np.ndarray, length: np.ndarray):
    scores = ahead @ weights["ahead_out"]
    scores += _turned(back @ weights["back_out"], length)
    scores += weights["bias"]
    by_class = np.ascontiguousarray(scores.reshape(-1, scores.shape[2]).T)
    by_class -= by_class.max(0)
    np.exp(by_class, out=by_class)
    by_class /= by_class.sum(0)
    return by_class.T.reshape(scores.shape)


def position_probabilities(
    weights: Weights, data: np.ndarray, start: np.ndarray, length: np.ndarray
) -> np.ndarray:
    """(step, span, class): probabilities at every position; zero beyond the end of a span."""
    ahead, back, running = _read(data, start, length)
    found = _probabilities(
        weights, _unit(weights, "ahead", ahead, running), _unit(weights, "back", back, running), length
    )
    for step, n in enumerate(running):
        found[step, n:] = 0
    return found


def pooled(
    weights: Weights, data: np.ndarray, offsets: np.ndarray, span: int = SPAN, batch: int = 4_096
) -> np.ndarray:
    """(text, class): mean probabilities over all positions of every text; zero for empty ones."""
    text, start, length = spans(data, offsets, span)
    total = np.zeros((len(offsets) - 1, len(weights["bias"])))
    for low in range(0, len(text), batch):
        part = slice(low, low + batch)
        found = position_probabilities(weights, data, start[part], length[part])
        np.add.at(total, text[part], found.sum(0, dtype=np.float64))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def _unit_gradients(
    weights: Weights, side: str, read: np.ndarray, running: np.ndarray, trace: list, wanted: np.ndarray
) -> Weights:
    """Backpropagation through time: ``wanted`` is the gradient of every state's own use."""
    inner = weights[f"{side}_state"]
    hidden = inner.shape[0]
    carried = np.zeros((0, hidden), inner.dtype)
    inner_gradient = np.zeros_like(inner)
    rows, places = [], []
    for step in range(len(running) - 1, -1, -1):
        n = running[step]
        state, keep, reset, fresh, pushed = trace[step]
        slope = wanted[step, :n].copy()
        slope[: len(carried)] += carried
        d_keep = slope * (state - fresh) * _slope(2 * keep - 1) * 0.5
        d_fresh = slope * (1 - keep) * _slope(fresh)
        d_reset = d_fresh * pushed * _slope(2 * reset - 1) * 0.5
        pushed_slope = np.concatenate([d_keep, d_reset, d_fresh * reset], 1)
        inner_gradient += state.T @ pushed_slope
        carried = slope * keep + pushed_slope @ inner.T
        rows.append(np.concatenate([d_keep, d_reset, d_fresh], 1))
        places.append(read[step, :n])
    slopes, places = np.concatenate(rows), np.concatenate(places)
    table = [np.bincount(places, slopes[:, i], 256) for i in range(3 * hidden)]
    return {f"{side}_state": inner_gradient, f"{side}_bytes": np.stack(table, 1).astype(inner.dtype)}


def gradients(
    weights: Weights, data: np.ndarray, start: np.ndarray, length: np.ndarray, label: np.ndarray
) -> tuple[float, Weights]:
    """Mean cross entropy over all positions and its gradient."""
    ahead, back, running = _read(data, start, length)
    traces: dict[str, list] = {"ahead": [], "back": []}
    states = {
        "ahead": _unit(weights, "ahead", ahead, running, traces["ahead"]),
        "back": _unit(weights, "back", back, running, traces["back"]),
    }
    found = _probabilities(weights, states["ahead"], states["back"], length)
    inside = np.arange(len(ahead))[:, None] < length
    count = inside.sum()
    right = np.take_along_axis(found, label[None, :, None], 2)[:, :, 0]
    loss = -float(np.log(np.maximum(right[inside], 1e-30)).sum() / count)
    slope = found
    slope[:, np.arange(len(label)), label] -= 1
    slope *= inside[:, :, None] / count
    slope = slope.astype(weights["bias"].dtype)
    classes, hidden = slope.shape[2], weights["ahead_state"].shape[0]
    out: Weights = {"bias": slope.sum((0, 1))}
    # a position's slope belongs to the backward step that reads it
    for side, read, part in (("ahead", ahead, slope), ("back", back, _turned(slope, length))):
        part = part * inside[:, :, None]
        flat = states[side].reshape(-1, hidden)
        out[f"{side}_out"] = flat.T @ part.reshape(-1, classes)
        out |= _unit_gradients(weights, side, read, running, traces[side], part @ weights[f"{side}_out"].T)
    return loss, out


def train(
    data: np.ndarray,
    start: np.ndarray,
    length: np.ndarray,
    label: np.ndarray,
    classes: int,
    hidden: int = HIDDEN,
    steps: int = 300,
    batch: int = 512,
    rate: float = 0.03,
    seed: int = 0,
) -> Weights:
    """Weights after ``steps`` steps of Adam over spans in random order; the same in every run."""
    weights = new_weights(classes, hidden, seed)
    draw = np.random.default_rng(seed)
    first = {k: np.zeros_like(w) for k, w in weights.items()}
    second = {k: np.zeros_like(w) for k, w in weights.items()}
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(start)):
            order = draw.permutation(len(start))
        chosen, order = order[:batch], order[batch:]
        chosen = chosen[np.argsort(-length[chosen], kind="stable")]
        _, slope = gradients(weights, data, start[chosen], length[chosen], label[chosen])
        pace = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
        for name, g in slope.items():
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            drift = first[name] / (1 - 0.9**step)
            spread = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8
            weights[name] = (weights[name] - pace * drift / spread).astype(np.float32)
    return weights
