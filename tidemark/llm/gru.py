"""A small gated recurrent network with a class-factored softmax, in numpy.

Many documents are run side by side in lanes.  A lane holds whole documents one
after the other; the state is carried from window to window and cleared where a
document begins, so each token is predicted from all of its document before it.
Gradients stop at the start of a window (truncated backpropagation).

A token is predicted as its class, times itself within the class.  The second
factor is a softmax for head words and left to the caller for all others.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 16
LANES = 512
WINDOW = 16
RATE = 0.15


class Layout:
    """Sizes: ``head_classes`` classes of ``per_class`` words, and classes without a softmax."""

    def __init__(self, head_classes: int, per_class: int, classes: int, hidden: int = HIDDEN):
        self.head_classes, self.per_class, self.classes = head_classes, per_class, classes
        self.hidden = hidden
        self.inputs = head_classes * per_class + classes
        self.shapes = {
            "enter": (self.inputs, 3 * hidden),
            "again": (hidden, 3 * hidden),
            "out": (hidden, classes),
            "out_bias": (classes,),
            "word": (head_classes, hidden, per_class),
            "word_bias": (head_classes, per_class),
        }

    def start(self, class_counts: np.ndarray, word_counts: np.ndarray) -> dict[str, np.ndarray]:
        """Weights that predict the plain counts whatever the state."""
        draw = np.random.default_rng(11)
        w = {k: np.zeros(s, np.float32) for k, s in self.shapes.items()}
        for name, scale in (("enter", 0.3), ("again", 0.4), ("out", 0.05), ("word", 0.05)):
            w[name] = (draw.standard_normal(self.shapes[name]) * scale).astype(np.float32)
        w["out_bias"] = np.log((class_counts + 1) / (class_counts + 1).sum()).astype(np.float32)
        words = word_counts.reshape(self.head_classes, self.per_class) + 0.01
        w["word_bias"] = np.log(words / words.sum(axis=1, keepdims=True)).astype(np.float32)
        return w

    def flat(self, weights: dict) -> np.ndarray:
        return np.concatenate([weights[k].ravel() for k in self.shapes])

    def unflat(self, values: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            out[name] = values[at : at + size].reshape(shape).astype(np.float32)
            at += size
        return out


def lanes(documents: list[np.ndarray], width: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """Documents dealt to lanes of about equal length: tokens and document numbers.

    Both are (steps, lanes), with -1 after the end of a lane; longer lanes come first.
    """
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    heap = [(0, k) for k in range(min(width, len(documents)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for i in order:
        length, k = heapq.heappop(heap)
        dealt[k].append(i)
        heapq.heappush(heap, (length + len(documents[i]), k))
    sizes = sorted(heap, reverse=True)
    steps = sizes[0][0] if sizes else 0
    tokens = np.full((steps, len(sizes)), -1, np.int32)
    owner = np.full((steps, len(sizes)), -1, np.int32)
    for row, (_, k) in enumerate(sizes):
        at = 0
        for i in dealt[k]:
            n = len(documents[i])
            tokens[at : at + n, row], owner[at : at + n, row] = documents[i], i
            at += n
    return tokens, owner


_SAFE = 40.0


def _softmax(x: np.ndarray, target: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the log-softmax at ``target``, and exponentials with their sum.

    No |x| is above ``bound``; ``x`` is overwritten.
    """
    if bound > _SAFE:
        x -= x.max(axis=1, keepdims=True)
    picked = x[np.arange(len(x)), target]
    np.exp(x, out=x)
    total = x @ np.ones((x.shape[1], 1), np.float32)
    return picked - np.log(total[:, 0]), x, total


def _biased(w: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Weights with the bias as a last row, for states that end with a 1."""
    return np.concatenate((w, bias[..., None, :]), axis=-2)


def _bound(w: np.ndarray) -> float:
    # A state lies within -1 and 1.
    return float(np.abs(w).sum(axis=-2).max())


def _thirds(w: np.ndarray) -> list[np.ndarray]:
    """Columns of the update gate, the reset gate and the new state, each contiguous."""
    return [np.ascontiguousarray(x) for x in np.split(w, 3, axis=1)]


class Network:
    """``seen`` adds up the squares of each weight's gradients, over earlier training too if given."""

    UNSEEN = 1e-4

    def __init__(
        self, layout: Layout, weights: dict[str, np.ndarray], seen: dict[str, np.ndarray] | None = None
    ):
        self.layout, self.w = layout, {k: v.copy() for k, v in weights.items()}
        if seen is None:
            self.seen = {k: np.full(v.shape, self.UNSEEN, np.float32) for k, v in weights.items()}
        else:
            self.seen = {k: v.copy() for k, v in seen.items()}

    def log_likelihoods(self, documents, entry, classes, within) -> np.ndarray:
        """Natural log-probabilities, per document, of classes and head words."""
        total = np.zeros(len(documents))
        for out, owner, valid in self._windows(documents, entry, classes, within, False):
            total += np.bincount(owner[valid], weights=out[valid], minlength=len(total))
        return total

    def train(self, documents, entry, classes, within) -> int:
        """One pass; returns the number of tokens."""
        return sum(int(valid.sum()) for *_, valid in self._windows(documents, entry, classes, within, True))

    def _windows(self, documents, entry, classes, within, learn):
        tokens, owner = lanes(documents)
        state = np.zeros((tokens.shape[1], self.layout.hidden), np.float32)
        for begin in range(0, len(tokens), WINDOW):
            now = tokens[begin : begin + WINDOW]
            active = int((now[0] >= 0).sum())
            now, who = now[:, :active], owner[begin : begin + WINDOW, :active]
            if begin:
                before = np.concatenate((tokens[begin - 1 : begin, :active], now[:-1]))
                was = np.concatenate((owner[begin - 1 : begin, :active], who[:-1]))
            else:
                before = np.concatenate((np.full((1, active), -1, np.int32), now[:-1]))
                was = np.concatenate((np.full((1, active), -1, np.int32), who[:-1]))
            valid = now >= 0
            fresh = was != who
            # The end token (number 0) stands before a document's first token.
            came = entry[np.where(fresh | ~valid, 0, before)]
            safe = np.where(valid, now, 0)
            state, out = self._step(state[:active], came, fresh, classes[safe], within[safe], valid, learn)
            yield out, who, valid

    @np.errstate(over="ignore")  # a gate whose exponential is infinite is 0
    def _step(self, state, came, fresh, target, word, valid, learn):
        w, size = self.w, self.layout.hidden
        steps, width = came.shape
        again = _thirds(w["again"])
        to_gate, to_reset = -again[0], -again[1]
        not_gate, not_reset, enter = _thirds(w["enter"])
        not_gate, not_reset = (-x.take(came, axis=0) for x in (not_gate, not_reset))
        enter = enter.take(came, axis=0)
        clear = [np.flatnonzero(f) for f in fresh]
        shape = (steps, width, size)
        hidden, prev, new, inner = (np.empty(shape, np.float32) for _ in range(4))
        gates = np.empty((steps, 2, width, size), np.float32)
        for t in range(steps):
            prev[t] = state
            state, both, made, after = prev[t], gates[t], new[t], hidden[t]
            if len(clear[t]):
                state[clear[t]] = 0
            np.matmul(state, to_gate, out=both[0])
            np.matmul(state, to_reset, out=both[1])
            both[0] += not_gate[t]
            both[1] += not_reset[t]
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)
            np.matmul(state, again[2], out=inner[t])
            np.multiply(both[1], inner[t], out=made)
            made += enter[t]
            np.tanh(made, out=made)
            np.subtract(state, made, out=after)
            after *= both[0]
            after += made
            state = after
        target, word, ok = target.ravel(), word.ravel(), valid.ravel()
        flat = np.ones((steps * width, size + 1), np.float32)
        flat[:, :size] = hidden.reshape(-1, size)
        padded = not ok.all()
        weight = _biased(w["out"], w["out_bias"])
        out, share, total = _softmax(flat @ weight, target, _bound(weight))
        if learn:
            share /= total
            share[np.arange(len(flat)), target] -= 1
            if padded:
                share[~ok] = 0
            d_hidden = share @ w["out"].T
            g = (share.T @ flat).T
            grads = {"out": g[:size], "out_bias": g[size]}
        # Tokens of one class stand together, so that each class is one product.
        bounds = np.concatenate(([0], np.cumsum(np.bincount(target, minlength=self.layout.head_classes))))
        bounds = bounds[: self.layout.head_classes + 1]
        at = np.argsort(target.astype(np.int16), kind="stable")[: bounds[-1]]
        some, which, some_ok = flat.take(at, axis=0), word[at], ok[at]
        picked, d_some = np.empty(len(at), np.float32), np.empty((len(at), size), np.float32)
        weight = _biased(w["word"], w["word_bias"])
        bound, g = _bound(weight), np.zeros_like(weight)
        for k in range(self.layout.head_classes):
            of = slice(bounds[k], bounds[k + 1])
            if bounds[k] == bounds[k + 1]:
                continue
            picked[of], share, total = _softmax(some[of] @ weight[k], which[of], bound)
            if learn:
                share /= total
                share[np.arange(len(share)), which[of]] -= 1
                if padded:
                    share[~some_ok[of]] = 0
                np.matmul(share, w["word"][k].T, out=d_some[of])
                g[k] = some[of].T @ share
        out[at] += picked
        if learn:
            d_hidden[at] += d_some
            grads |= {"word": g[:, :size], "word_bias": g[:, size]}
            d_hidden = d_hidden.reshape(shape)
            gate, reset = gates[:, 0], gates[:, 1]
            not_gate = 1 - gate
            # Overwritten with the gradients before each activation, step by step.
            d_new = not_gate * (1 - new * new)
            d_gate = (prev - new) * gate * not_gate
            d_reset = inner * reset * (1 - reset)
            d_inner = np.empty(shape, np.float32)
            from_gate, from_reset, from_inner = (x.T.copy() for x in again)
            back = np.zeros((width, size), np.float32)
            for t in range(steps - 1, -1, -1):
                d = d_hidden[t]
                d += back
                d_new[t] *= d
                d_gate[t] *= d
                d_reset[t] *= d_new[t]
                np.multiply(d_new[t], reset[t], out=d_inner[t])
                back = d * gate[t]
                back += d_gate[t] @ from_gate
                back += d_reset[t] @ from_reset
                back += d_inner[t] @ from_inner
                if len(clear[t]):
                    back[clear[t]] = 0
            before = prev.reshape(-1, size).T
            d_gate, d_reset, d_new, d_inner = (x.reshape(-1, size) for x in (d_gate, d_reset, d_new, d_inner))
            grads["again"] = np.concatenate((before @ d_gate, before @ d_reset, before @ d_inner), axis=1)
            # A window of few tokens moves the weights little.
            self._learn(grads, came.ravel(), np.concatenate((d_gate, d_reset, d_new), axis=1), LANES * WINDOW)
        return state, out.reshape(steps, width)

    def _learn(self, grads, came, d_enter, n) -> None:
        """Adagrad; of the input table only the rows in use are touched."""
        for name, g in grads.items():
            self._move(name, slice(None), g / n)
        order = np.argsort(came.astype(np.int16), kind="stable")
        sorted_ = came.take(order)
        starts = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        self._move("enter", sorted_[starts], np.add.reduceat(d_enter.take(order, axis=0), starts, axis=0) / n)

    def _move(self, name, where, g) -> None:
        seen = self.seen[name]
        seen[where] += g * g * 1e4
        self.w[name][where] -= RATE * 1e2 * g / np.sqrt(seen[where])
