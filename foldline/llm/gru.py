"""A gated recurrent language model in numpy: truncated backpropagation, class-factored softmax.

A step reads the previous token id and gives the next token's class, then the token within its class.
Ids are 0..K-1; some classes hold one id. All arrays are float32, sums of log-probabilities float64.
"""

from __future__ import annotations

from itertools import pairwise
from typing import NamedTuple

import numpy as np

HIDDEN = 24


def classes_of(counts: np.ndarray, classes: int, largest: int = 64) -> np.ndarray:
    """Class of each id: ids by falling count, cut into classes of about equal count."""
    order = np.argsort(-counts, kind="stable")
    share, out = counts.sum() / classes, np.zeros(len(counts), np.int32)
    own, mass, size = 0, 0.0, 0
    for i in order:
        if size and (mass + counts[i] / 2 > share or size >= largest):
            own, mass, size = own + 1, 0.0, 0
        out[i] = own
        mass += counts[i]
        size += 1
    return out


def new_model(counts: np.ndarray, classes: int = 32, hidden: int = HIDDEN, seed: int = 7) -> dict[str, np.ndarray]:
    """A model that starts as the smoothed unigram model of ``counts``."""
    counts = np.asarray(counts, np.float64) + 0.5
    own = classes_of(counts, classes)
    k, c = len(counts), int(own.max()) + 1
    rng = np.random.default_rng(seed)
    mass = np.bincount(own, counts, c)
    return {
        "class": own,
        "X": (rng.standard_normal((k, 3 * hidden)) * 0.1).astype(np.float32),
        "U": (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32),
        "V": np.zeros((hidden, c), np.float32),
        "v": np.log(mass / mass.sum()).astype(np.float32),
        "W": np.zeros((k, hidden), np.float32),
        "w": np.log(counts / mass[own]).astype(np.float32),
    }


PARAMETERS = ["X", "U", "V", "v", "W", "w"]


def pack(model: dict) -> np.ndarray:
    return np.concatenate([model[n].ravel() for n in PARAMETERS])


def unpack(model: dict, flat: np.ndarray) -> dict:
    out, at = {"class": model["class"]}, 0
    for n in PARAMETERS:
        size = model[n].size
        out[n] = flat[at: at + size].reshape(model[n].shape).astype(np.float32)
        at += size
    return out


class Members(NamedTuple):
    """The ids sorted by class, each id's place in that order and in its class, and where classes begin."""

    ids: np.ndarray
    rank: np.ndarray
    place: np.ndarray
    starts: list[int]


def members(model: dict) -> Members:
    ids = np.argsort(model["class"], kind="stable")
    starts = np.searchsorted(model["class"][ids], np.arange(int(model["class"].max()) + 2))
    rank = np.empty(len(ids), np.int64)
    rank[ids] = np.arange(len(ids))
    return Members(ids, rank, rank - starts[model["class"]], starts.tolist())


def _cell(ut, x, h):
    """One step on columns: ut is ``_across``, x (3 hidden, lanes) the ``_inputs``, h (hidden, lanes).

    Returns the new state, z, r, n and the part of u that r lets through; z, r and n replace x."""
    hidden, u = len(h), ut @ h
    zr, n, passed = x[: 2 * hidden], x[2 * hidden:], u[2 * hidden:]
    zr += u[: 2 * hidden]
    np.tanh(zr, out=zr)
    zr *= HALF
    zr += HALF
    z, r = zr[:hidden], zr[hidden:]
    n += r * passed
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, z, r, n, passed


def _across(model):
    """U transposed, z and r halved: their sigmoid is (1 + tanh(x / 2)) / 2, and halves are exact."""
    ut = np.array(model["U"].T, order="C")
    ut[: 2 * model["U"].shape[0]] *= 0.5
    return ut


def _inputs(x, previous):
    """A new array of the rows of x, X or ``_halved`` X, for the previous ids (..., lanes), as columns
    (..., 3 hidden, lanes)."""
    return np.array(np.swapaxes(x.take(previous, axis=0, mode="clip"), -1, -2), order="C")


def _halved(model):
    """X with z and r halved, like ``_across``."""
    x = model["X"].copy()
    x[:, : 2 * model["U"].shape[0]] *= 0.5
    return x


def _step(model, previous, h):
    """One step on rows (lanes, hidden)."""
    return tuple(a.T for a in _cell(_across(model), _halved(model)[previous].T, h.T))


HALF = np.array(0.5, np.float32)  # an array, since a plain number is converted at each use
STATES = 1 << 13  # columns of the class layer computed at once, so that they stay in the cache
INPUTS = 1 << 10  # columns of inputs that are gathered for several steps at once


def _output(model, groups, hidden, target, grads=None, read=None):
    """log P of each target given its state; with ``grads``, adds gradients, notes in ``grads["rows"]``
    which ids have one in W and w, and returns dH too.

    ``read`` names the rows of ``hidden`` that have a target, in order, if not all have; dH is zero
    in the others. Works on columns sorted by the class of the target, so every class is one slice,
    with the parameters of the ids sorted alike."""
    own = model["class"][target]
    order = np.argsort(own.astype(np.int16), kind="stable")
    own, target, rows = own[order], target[order], len(hidden)
    chosen = order if read is None else read[order]
    hidden = hidden.take(chosen, axis=0, mode="clip").T
    starts, place = groups.starts, groups.place[target]
    edges = np.searchsorted(own, np.arange(len(starts))).tolist()
    at = np.arange(len(target))
    found, total = np.empty((2, len(at)), hidden.dtype)
    d_hidden = None if grads is None else np.empty(hidden.shape, hidden.dtype)
    pieces = max(1, len(at) // STATES)
    for a, b in pairwise(len(at) * i // pieces for i in range(pieces + 1)):
        e = model["V"].T @ hidden[:, a:b]
        e += model["v"][:, None]
        e -= np.maximum.reduce(e, axis=0)
        found[a:b] = e[own[a:b], at[: b - a]]
        np.add.reduce(np.exp(e, out=e), axis=0, out=total[a:b])
        if grads is not None:
            e /= total[a:b]
            e[own[a:b], at[: b - a]] -= 1
            grads["V"] += hidden[:, a:b] @ e.T
            grads["v"] += e.sum(axis=1)
            np.matmul(model["V"], e, out=d_hidden[:, a:b])
    logp = (found - np.log(total)).astype(np.float64)
    weights, biases = model["W"].take(groups.ids, axis=0), model["w"][groups.ids][:, None]
    found.fill(0), total.fill(1)
    if grads is not None:
        d_weights, d_biases, used = np.empty_like(weights), np.empty_like(model["w"]), [np.arange(0)]
    for a, b, s, t in zip(edges[:-1], edges[1:], starts[:-1], starts[1:]):
        if t - s < 2 or a == b:
            continue
        part, inside, along = hidden[:, a:b], place[a:b], at[: b - a]
        e = weights[s:t] @ part
        e += biases[s:t]
        e -= np.maximum.reduce(e, axis=0)
        found[a:b] = e[inside, along]
        np.add.reduce(np.exp(e, out=e), axis=0, out=total[a:b])
        if grads is not None:
            e /= total[a:b]
            e[inside, along] -= 1
            np.matmul(e, part.T, out=d_weights[s:t])
            np.add.reduce(e, axis=1, out=d_biases[s:t])
            d_hidden[:, a:b] += weights[s:t].T @ e
            used.append(np.arange(s, t))
    logp += found - np.log(total)
    result = np.empty_like(logp)
    result[order] = logp
    if grads is None:
        return result, None
    used = np.concatenate(used)
    rows_used = groups.ids[used]
    grads["W"][rows_used] += d_weights[used]
    grads["w"][rows_used] += d_biases[used]
    grads["rows"] = {"W": rows_used, "w": rows_used}
    back = np.full(rows, -1)
    back[chosen] = at
    d_hidden = d_hidden.take(back, axis=1, mode="clip")
    if len(at) < rows:
        d_hidden[:, back < 0] = 0
    return result, d_hidden.T


def score(model: dict, ids: np.ndarray, first: np.ndarray, start: int, lanes: int = 2048, window: int = 32) -> np.ndarray:
    """Natural-log probability of each text: ids[first[i]:first[i + 1]], read from ``start`` on.

    Texts run side by side, longest first; the state is carried from step to step, so each text
    is scored whole. States are read window by window, or, where few texts are that long, when
    STATES are gathered. Memory is lanes * window states, whatever the lengths."""
    groups, lengths = members(model), np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    result = np.zeros(len(lengths), np.float64)
    hidden = model["U"].shape[0]
    ut, inputs = _across(model), _halved(model)
    states = np.empty((min(lanes, len(order)) * window, hidden), np.float32)
    for a in range(0, len(order), lanes):
        docs = order[a: a + lanes]
        length, base = lengths[docs], first[docs]
        h = np.zeros((hidden, len(docs)), np.float32)
        previous = np.full((1, len(docs)), start, ids.dtype)
        steps = int(length[0]) if len(length) else 0
        alive = np.searchsorted(-length, -np.arange(steps), "left")  # texts longer than t
        same = (steps - np.searchsorted(alive[::-1], alive, "left")).tolist()  # where fewer are
        alive = alive.tolist()
        t, size, targets, who = 0, 0, [], []
        while t < steps:
            live = alive[t]  # as many for so many steps, of which the inputs are gathered at once
            run = min(same[t] - t, window - t % window, (len(states) - size) // live, max(1, INPUTS // live))
            target = ids[base[:live] + np.arange(t, t + run)[:, None]]
            x = _inputs(inputs, np.concatenate([previous[:, :live], target[:-1]]))
            for k in range(run):
                h = _cell(ut, x[k], h[:, :live])[0]
                states[size: size + live] = h.T
                size += live
            t, previous = t + run, target[-1:]
            targets.append(target.ravel()), who.append(np.tile(docs[:live], run))
            full = size + live > len(states) or (size >= STATES and t % window == 0)
            if full or t == steps:
                logp, _ = _output(model, groups, states[:size], np.concatenate(targets))
                result += np.bincount(np.concatenate(who), logp, len(result))
                size, targets, who = 0, [], []
    return result


def gradients(model: dict, groups, inputs, targets, mask, h0):
    """(sum of log P, gradients, last state) of one window: arrays (steps, lanes).

    ``rows`` of the gradients names the ids that may have one in X, W and w; the others have none.
    ``mask`` holds the first steps of each lane; the state after a lane's last step is not used."""
    steps, lanes, hidden = *inputs.shape, h0.shape[1]
    ut, x = _across(model), _inputs(model["X"], inputs)
    x[:, : 2 * hidden] *= 0.5
    states = np.empty((steps + 1, hidden, lanes), h0.dtype)
    states[0] = h0.T
    passed = []
    for t in range(steps):  # x becomes z, r and n
        states[t + 1], *_, u = _cell(ut, x[t], states[t])
        passed.append(u)
    grads = {k: np.zeros(model[k].shape, model[k].dtype) for k in PARAMETERS}
    after = states[1:].transpose(0, 2, 1).reshape(-1, hidden)
    read = np.flatnonzero(mask)
    logp, rows = _output(model, groups, after, targets.ravel()[read], grads, read)
    d_out = np.ascontiguousarray(rows.T.reshape(hidden, steps, lanes).transpose(1, 0, 2))
    d_in = np.empty((steps, 3 * hidden, lanes), h0.dtype)  # by input: z, r, n before their functions
    d_n = np.empty((steps, hidden, lanes), h0.dtype)
    change, slope = states[:-1] - x[:, 2 * hidden:], 1 - x[:, 2 * hidden:] * x[:, 2 * hidden:]
    rest = 1 - x[:, : 2 * hidden]
    carry = np.zeros((hidden, lanes), h0.dtype)
    for t in range(steps - 1, -1, -1):
        gate, dn = d_in[t], d_n[t]
        carry += d_out[t]
        dz = carry * x[t, :hidden]
        carry -= dz
        np.multiply(carry, slope[t], out=dn)
        np.multiply(dn, x[t, hidden: 2 * hidden], out=gate[2 * hidden:])
        np.multiply(gate[2 * hidden:], passed[t], out=gate[hidden: 2 * hidden])
        np.multiply(dz, rest[t, :hidden], out=gate[:hidden])
        gate[hidden: 2 * hidden] *= rest[t, hidden:]
        gate[:hidden] *= change[t]
        carry = model["U"] @ gate
        carry += dz
    d_in = d_in.transpose(1, 0, 2).reshape(3 * hidden, -1)
    grads["U"] += (d_in @ states[:-1].transpose(1, 0, 2).reshape(hidden, -1).T).T
    d_in[2 * hidden:] = d_n.transpose(1, 0, 2).reshape(hidden, -1)
    flat = inputs.ravel()
    order = np.argsort(flat.astype(np.int16) if len(model["X"]) < 1 << 15 else flat, kind="stable")
    flat = flat[order]
    starts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    grads["rows"]["X"] = flat[starts]
    grads["X"][flat[starts]] = np.add.reduceat(d_in.take(order, axis=1, mode="wrap"), starts, axis=1).T
    return logp.sum(), grads, states[-1].T


def train(model: dict, ids: np.ndarray, first: np.ndarray, start: int, memory: dict | None = None,
          lanes: int = 64, window: int = 16, rate: float = 0.03) -> tuple[dict, dict]:
    """One pass over the texts by truncated backpropagation: lanes read whole texts one after the
    other, longest first, the state is carried over windows and cleared between texts. Adagrad steps
    on the mean gradient of a window; ``memory`` is its state, for a further call."""
    groups = members(model)
    memory = memory or {k: np.full_like(model[k], 1e-6) for k in PARAMETERS}
    lengths = np.diff(first)
    waiting = np.argsort(-lengths, kind="stable")
    waiting = waiting[: np.count_nonzero(lengths)]
    lanes, hidden = min(lanes, len(waiting)), model["U"].shape[0]
    text, waiting = waiting[:lanes], waiting[lanes:]
    place, stop = first[text], first[text + 1]
    h, previous = np.zeros((lanes, hidden), np.float32), np.full(lanes, start, np.int64)
    while len(place):
        at = place + np.arange(window)[:, None]
        mask = at < stop
        targets = ids[np.where(mask, at, 0)]
        inputs = np.concatenate([previous[None], targets[:-1]])
        _, grads, h = gradients(model, groups, inputs, targets, mask, h)
        count = np.float32(mask.sum())
        for k in PARAMETERS:
            rows = grads["rows"].get(k)  # the others have no gradient, and stay as they are
            if rows is None or 2 * len(rows) > len(grads[k]):
                rows = slice(None)
            g = grads[k][rows]
            g /= count
            squares = memory[k][rows] + g * g
            memory[k][rows] = squares
            g *= rate
            g /= np.sqrt(squares)
            model[k][rows] -= g
        place, previous, h = place + window, targets[-1].astype(np.int64), np.ascontiguousarray(h)
        ended = np.flatnonzero(place >= stop)
        if len(ended):
            fresh, lost = ended[: len(waiting)], ended[len(waiting):]
            text, waiting = waiting[: len(fresh)], waiting[len(fresh):]
            place[fresh], stop[fresh], h[fresh], previous[fresh] = first[text], first[text + 1], 0, start
            if len(lost):
                place, stop, previous, h = (np.delete(x, lost, axis=0) for x in (place, stop, previous, h))
    return model, memory
