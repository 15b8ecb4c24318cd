"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Windows are batches of character classes; the LSTM runs over the time steps of
all windows at once.  The CRF scores tag sequences (B and I of each kind, and O);
its forward-backward pass gives the gradient, Viterbi the best sequence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # 0 is O; 1 + 2k and 2 + 2k are B and I of kind k
CLASSES = 98
FORBIDDEN = -1e4


def character_classes(points: np.ndarray) -> np.ndarray:
    """Printable ASCII each by itself; other letters and signs in three classes."""
    ascii_class = np.clip(points.astype(np.int64) - 32, 0, 94)
    return np.where(
        (points >= 32) & (points < 127), ascii_class, np.where(points < 32, 95, np.where(points < 0x250, 96, 97))
    )


def allowed() -> np.ndarray:
    """Scores that forbid an I after anything but the B or I of its kind."""
    table = np.zeros((TAGS + 1, TAGS))  # the last row is the start
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        table[:, inside] = FORBIDDEN
        table[[inside - 1, inside], inside] = 0.0
    return table


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@dataclass(frozen=True)
class Settings:
    window: int = 64
    stride: int = 32
    embedding: int = 10
    hidden: int = 14
    epochs: int = 14
    batch: int = 48
    rate: float = 0.02
    seed: int = 5


class Network:
    """Weights, training and emission scores."""

    def __init__(self, settings: Settings):
        rng, e, h = np.random.default_rng(settings.seed), settings.embedding, settings.hidden
        self.settings = settings
        self.weights = {"embed": rng.normal(0, 0.5, (CLASSES, e))}
        for side in ("fore", "back"):
            self.weights[side] = rng.normal(0, 1 / np.sqrt(e + h), (e + h, 4 * h))
            self.weights[side + "_bias"] = np.concatenate((np.ones(h), np.zeros(3 * h)))
        self.weights["out"] = rng.normal(0, 0.3, (2 * h, TAGS))
        self.weights["out_bias"] = np.zeros(TAGS)
        self.weights["moves"] = rng.normal(0, 0.1, (TAGS + 1, TAGS))

    def _lstm(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States over time steps (time first), and what the gradient needs."""
        w, b, h = self.weights[side], self.weights[side + "_bias"], self.settings.hidden
        state = cell = np.zeros((x.shape[1], h))
        out, kept = np.empty((len(x), x.shape[1], h)), []
        for t in range(len(x)):
            into = np.concatenate((x[t], state), 1)
            z = into @ w + b
            gates = _sigmoid(z[:, : 3 * h])
            forget, put, show = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            new = np.tanh(z[:, 3 * h :])
            before, cell = cell, forget * cell + put * new
            squashed = np.tanh(cell)
            state = show * squashed
            out[t] = state
            kept.append((into, forget, put, show, new, before, squashed))
        return out, kept

    def _lstm_gradient(self, grad: np.ndarray, kept: list, side: str, into_grads: dict) -> np.ndarray:
        w, h, e = self.weights[side], self.settings.hidden, self.settings.embedding
        d_state = d_cell = np.zeros((grad.shape[1], h))
        d_x = np.empty((len(grad), grad.shape[1], e))
        for t in range(len(grad) - 1, -1, -1):
            into, forget, put, show, new, before, squashed = kept[t]
            d_state = d_state + grad[t]
            d_cell = d_cell + d_state * show * (1 - squashed**2)
            d_z = np.concatenate(
                (
                    d_cell * before * forget * (1 - forget),
                    d_cell * new * put * (1 - put),
                    d_state * squashed * show * (1 - show),
                    d_cell * put * (1 - new**2),
                ),
                1,
            )
            into_grads[side] += into.T @ d_z
            into_grads[side + "_bias"] += d_z.sum(0)
            d_into = d_z @ w.T
            d_x[t], d_state = d_into[:, :e], d_into[:, e:]
            d_cell = d_cell * forget
        return d_x

    def emissions(self, windows: np.ndarray) -> np.ndarray:
        """Tag scores of windows of character classes: (window, position, tag)."""
        x = self.weights["embed"][windows].transpose(1, 0, 2)
        fore, _ = self._lstm(x, "fore")
        back, _ = self._lstm(x[::-1], "back")
        both = np.concatenate((fore, back[::-1]), 2)
        return (both @ self.weights["out"] + self.weights["out_bias"]).transpose(1, 0, 2)

    @property
    def moves(self) -> np.ndarray:
        return self.weights["moves"] + allowed()

    def _loss_gradient(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        grads = {name: np.zeros_like(value) for name, value in self.weights.items()}
        x = self.weights["embed"][windows].transpose(1, 0, 2)
        fore, kept_fore = self._lstm(x, "fore")
        back, kept_back = self._lstm(x[::-1], "back")
        both = np.concatenate((fore, back[::-1]), 2)
        scores = both @ self.weights["out"] + self.weights["out_bias"]
        moves, n, steps = self.moves, len(windows), len(x)
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0] + moves[-1]
        for t in range(1, steps):
            alpha[t] = scores[t] + _logsumexp(alpha[t - 1][:, :, None] + moves[:-1], 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsumexp(moves[:-1] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[-1], 1)
        d_scores = np.exp(alpha + beta - total[:, None])
        rows, by_time = np.arange(n), tags.T
        gold = scores[np.arange(steps)[:, None], rows, by_time].sum(0) + moves[-1, by_time[0]]
        grads["moves"][-1] += d_scores[0].sum(0)
        np.add.at(grads["moves"][-1], by_time[0], -1)
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + moves[:-1] + (scores[t] + beta[t])[:, None, :]
            grads["moves"][:-1] += np.exp(pair - total[:, None, None]).sum(0)
            np.add.at(grads["moves"], (by_time[t - 1], by_time[t]), -1)
            gold = gold + moves[by_time[t - 1], by_time[t]]
        d_scores[np.arange(steps)[:, None], rows, by_time] -= 1
        grads["out"] = np.einsum("tnh,tnk->hk", both, d_scores)
        grads["out_bias"] = d_scores.sum((0, 1))
        d_both, h = d_scores @ self.weights["out"].T, self.settings.hidden
        d_x = self._lstm_gradient(d_both[:, :, :h], kept_fore, "fore", grads)
        d_x += self._lstm_gradient(d_both[::-1, :, h:], kept_back, "back", grads)[::-1]
        np.add.at(grads["embed"], windows.T, d_x)
        return float((total - gold).mean()), {name: value / n for name, value in grads.items()}

    def fit(self, windows: np.ndarray, tags: np.ndarray) -> list[float]:
        """Adam over shuffled batches; returns the mean loss per epoch."""
        rng, s = np.random.default_rng(self.settings.seed + 1), self.settings
        first = {name: np.zeros_like(value) for name, value in self.weights.items()}
        second = {name: np.zeros_like(value) for name, value in self.weights.items()}
        losses, step = [], 0
        for epoch in range(s.epochs):
            order, rate = rng.permutation(len(windows)), s.rate * (1 - epoch / s.epochs)
            seen = []
            for at in range(0, len(order), s.batch):
                chosen = order[at : at + s.batch]
                loss, grads = self._loss_gradient(windows[chosen], tags[chosen])
                seen.append(loss)
                step += 1
                for name, grad in grads.items():
                    grad = np.clip(grad, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * grad
                    second[name] = 0.999 * second[name] + 0.001 * grad**2
                    up, down = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                    self.weights[name] = self.weights[name] - rate * up / (np.sqrt(down) + 1e-8)
            losses.append(float(np.mean(seen)))
        return losses

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of one sequence of emission scores."""
        moves, back = self.moves, np.empty(scores.shape, dtype=np.int64)
        best = scores[0] + moves[-1]
        for t in range(1, len(scores)):
            paths = best[:, None] + moves[:-1]
            back[t] = paths.argmax(0)
            best = scores[t] + paths.max(0)
        tags = np.empty(len(scores), dtype=np.int64)
        tags[-1] = best.argmax()
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags
