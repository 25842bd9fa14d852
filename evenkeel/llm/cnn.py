"""A small byte-level convolutional network, in NumPy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

DIMENSIONS = 6
WIDTH = 9
STRIDE = 3
FILTERS = 48
STEPS = 64  # windows in half a chunk; a chunk is two halves and overlaps the next by one
HIDDEN = 32
HALF = STEPS * STRIDE


@dataclass
class Network:
    """Filters slide over the embedded bytes of the whole text; each overlapping chunk keeps its largest responses.

    The mean, the largest and the smallest over the chunks go through a hidden layer to one probability.
    """

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int) -> Network:
        draw = np.random.default_rng(seed)
        shape = {
            "embed": (256, DIMENSIONS), "filters": (WIDTH * DIMENSIONS, FILTERS), "bias": (FILTERS,),
            "hidden": (3 * FILTERS, HIDDEN), "hidden_bias": (HIDDEN,), "out": (HIDDEN,), "out_bias": (1,),
        }
        scale = {
            "embed": 0.5, "filters": (WIDTH * DIMENSIONS) ** -0.5, "hidden": (3 * FILTERS) ** -0.5, "out": HIDDEN**-0.5
        }
        return Network({k: (draw.standard_normal(s) * scale.get(k, 0.0)).astype(np.float32) for k, s in shape.items()})

    def _respond(self, texts: Sequence[bytes]) -> dict:
        """Responses per half chunk; every text is padded by more than a filter's width, and windows start in the text."""
        halves = np.array([(max(1, len(t)) + WIDTH - 1) // HALF + 1 for t in texts])
        data = np.zeros(int(halves.sum()) * HALF + WIDTH, dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum(halves)[:-1]]) * HALF
        inside = np.zeros(int(halves.sum()) * STEPS, dtype=bool)
        for text, begin in zip(texts, begins, strict=True):
            data[begin : begin + len(text)] = np.frombuffer(text, dtype=np.uint8)
            inside[begin // STRIDE : begin // STRIDE + max(1, -(-len(text) // STRIDE))] = True
        windows = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[: len(inside) * STRIDE : STRIDE][inside]
        w = self.weights
        # An embedded byte times its slice of the filters, for all bytes at once, would be a larger table than the text.
        seen = w["embed"][windows].reshape(len(windows), -1)
        response = np.full((len(inside), FILTERS), -1e9, dtype=np.float32)
        response[inside] = seen @ w["filters"] + w["bias"]
        # The padding may fill a last half, in which no window starts.
        used = np.flatnonzero(inside.reshape(-1, STEPS).any(axis=1))
        text_of = np.repeat(np.arange(len(texts)), halves)
        return {
            "halves": np.bincount(
                text_of[used], minlength=len(texts)
            ), "used": used, "windows": windows, "seen": seen, "inside": inside,
            "response": response.reshape(-1, STEPS, FILTERS)[used],
        }

    def _combine(self, pooled: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Mean, largest and smallest over the chunks of each text, and where the last two are."""
        last = np.cumsum(halves) - 1
        first = last - halves + 1
        chunk = pooled.copy()
        inner = np.ones(len(pooled), dtype=bool)
        inner[last] = False
        at = np.flatnonzero(inner)
        chunk[at] = np.maximum(pooled[at], pooled[at + 1])
        # A text's last half is covered by the chunk before it, unless it is the only one.
        counted = inner.copy()
        counted[last[halves == 1]] = True
        chunk = chunk[counted]
        sizes = np.maximum(halves - 1, 1)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mean = np.add.reduceat(chunk, begin, axis=0) / sizes[:, None]
        joined = np.concatenate(
            [mean, np.maximum.reduceat(chunk, begin, axis=0), np.minimum.reduceat(chunk, begin, axis=0)], axis=1
        )
        return joined.astype(chunk.dtype), [counted, chunk, sizes, first]

    def _head(self, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights
        hidden = np.maximum(joined @ w["hidden"] + w["hidden_bias"], 0)
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"], -30, 30)))

    def score(self, texts: Sequence[bytes], at_once: int = 1 << 17) -> np.ndarray:
        """The probability of each text, worked out for about ``at_once`` bytes together; long texts go alone."""
        out, some, size = [], [], 0
        for i, text in enumerate(texts):
            some.append(text)
            size += len(text) + HALF
            if size >= at_once or i + 1 == len(texts):
                pooled, halves = self._pooled(some, at_once)
                out.append(self._head(self._combine(pooled, halves)[0])[1])
                some, size = [], 0
        return np.concatenate(out) if out else np.zeros(0)

    def _pooled(self, texts: Sequence[bytes], at_once: int) -> tuple[np.ndarray, np.ndarray]:
        """Half chunks' largest responses; a text longer than ``at_once`` is worked through piece by piece."""
        if len(texts) > 1 or len(texts[0]) <= 2 * at_once:
            found = self._respond(texts)
            return found["response"].max(axis=1), found["halves"]
        step, parts = max(1, at_once // HALF) * HALF, []
        for begin in range(0, len(texts[0]), step):
            # The next piece's first bytes complete this one's last windows.
            found = self._respond([texts[0][begin : begin + step + WIDTH - 1]])
            parts.append(found["response"].max(axis=1)[: step // HALF])
        pooled = np.concatenate(parts)
        return pooled, np.array([len(pooled)])

    def gradients(self, texts: Sequence[bytes], labels: np.ndarray, importance: np.ndarray) -> tuple[
        float, dict[str, np.ndarray]
    ]:
        """Weighted log loss of some texts and its gradients."""
        w, found = self.weights, self._respond(texts)
        response, halves = found["response"], found["halves"]
        where = response.argmax(axis=1)
        pooled = np.take_along_axis(response, where[:, None, :], axis=1)[:, 0]
        joined, (counted, chunk, sizes, _) = self._combine(pooled, halves)
        hidden, p = self._head(joined)
        loss = float(
            -(importance * (labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7))).sum() / importance.sum()
        )
        d_logit = ((p - labels) * importance / importance.sum()).astype(np.float32)
        d_hidden = d_logit[:, None] * w["out"] * (hidden > 0)
        d_joined = d_hidden @ w["hidden"].T
        g = {
            "out": hidden.T @ d_logit,
            "out_bias": d_logit.sum(keepdims=True),
            "hidden": joined.T @ d_hidden,
            "hidden_bias": d_hidden.sum(axis=0),
        }
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        d_chunk = d_joined[text_of, :FILTERS] / sizes[text_of, None]
        for part in (1, 2):
            columns = slice(part * FILTERS, (part + 1) * FILTERS)
            best = chunk == joined[text_of, columns]
            ties = np.add.reduceat(best.astype(np.float32), np.cumsum(sizes) - sizes, axis=0)  # neighbours share a half
            d_chunk += best * (d_joined[:, columns] / ties)[text_of]
        d_pooled = np.zeros_like(pooled)
        at = np.flatnonzero(counted)
        alone = np.repeat(halves == 1, sizes)
        follow = np.minimum(at + 1, len(pooled) - 1)
        own = (pooled[at] >= pooled[follow]) | alone[:, None]
        d_pooled[at] += d_chunk * own
        d_pooled[follow] += d_chunk * ~own
        rows = np.cumsum(found["inside"]) - 1
        flat = (found["used"][:, None] * STEPS + where).ravel()
        column = np.tile(np.arange(FILTERS), len(pooled))
        real = found["inside"][flat]
        flat, column, value = rows[flat[real]], column[real], d_pooled.ravel()[real]
        g["bias"] = np.bincount(column, weights=value, minlength=FILTERS)
        d_response = np.zeros((len(found["seen"]), FILTERS), dtype=np.float32)
        np.add.at(d_response, (flat, column), value)
        touched = np.unique(flat)
        d_response = d_response[touched]
        g["filters"] = found["seen"][touched].T @ d_response
        d_seen = (d_response @ w["filters"].T).reshape(-1, DIMENSIONS)
        byte = found["windows"][touched].ravel()
        g["embed"] = np.stack(
            [np.bincount(byte, weights=d_seen[:, k], minlength=256) for k in range(DIMENSIONS)], axis=1
        )
        return loss, {k: v.astype(np.float32) for k, v in g.items()}


def fit(
    texts: Sequence[bytes],
    labels: np.ndarray,
    importance: np.ndarray | None = None,
    epochs: int = 5,
    batch: int = 32,
    rate: float = 0.006,
    seed: int = 42,
) -> Network:
    """A network trained by Adam on the texts in seeded order; one thread and one seed give the same network."""
    net, draw = Network.fresh(seed), np.random.default_rng(seed + 1)
    labels = np.asarray(labels, dtype=np.float32)
    weight = np.ones(len(labels), dtype=np.float32) if importance is None else np.asarray(importance, dtype=np.float32)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step, steps = 0, max(1, epochs * -(-len(texts) // batch))
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            _, grads = net.gradients([texts[i] for i in some], labels[some], weight[some])
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.weights[k] = net.weights[k] - now * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                )
    return net
