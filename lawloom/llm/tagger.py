"""A character tagger in numpy: LSTMs in both directions under a linear-chain CRF."""

import numpy as np

CLASSES = 100


def char_classes(text: str) -> np.ndarray:
    """Printable ASCII characters each, then other blanks, other letters, others; 0 stands for no character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(len(codes), 98, np.uint8)
    ascii_ = (codes >= 32) & (codes < 127)
    out[ascii_] = codes[ascii_] - 31
    out[codes < 32] = 96
    far = np.flatnonzero(codes >= 127)
    if len(far):
        out[far[[text[i].isalpha() for i in far]]] = 97
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.negative(x)
    np.exp(out, out)
    out += 1
    return np.divide(1, out, out)


class Tagger:
    def __init__(self, tags: int, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.15, shape).astype(np.float32)
        self.hidden, self.tags = hidden, tags
        # one table per direction: what a character adds to the four gates; then the recurrent weights
        self.p = {"x0": draw(CLASSES, 4 * hidden), "x1": draw(CLASSES, 4 * hidden), "u0": draw(hidden, 4 * hidden), "u1": draw(hidden, 4 * hidden),
                  "w": draw(2 * hidden, tags), "b": np.zeros(tags, np.float32), "t": np.zeros((tags, tags), np.float32)}
        for x in ("x0", "x1"):
            self.p[x][:, hidden : 2 * hidden] += 1.0  # begin with open forget gates

    def _lstm(self, codes: np.ndarray, way: int, trace: list | None = None) -> np.ndarray:
        """(time, batch, hidden) of one direction; codes: (time, batch), already reversed for the second."""
        x, u, n = self.p[f"x{way}"], self.p[f"u{way}"], self.hidden
        h = c = np.zeros((codes.shape[1], n), np.float32)
        out = np.empty((*codes.shape, n), np.float32)
        for t, now in enumerate(codes):
            z = x[now] + h @ u
            gates = _sigmoid(z[:, : 3 * n])
            i, f, o, g = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :], np.tanh(z[:, 3 * n :])
            before, c_before = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if trace is not None:
                trace.append((before, c_before, i, f, o, g, tc))
        return out

    def _back(self, codes: np.ndarray, way: int, trace: list, d_out: np.ndarray, grads: dict) -> None:
        u = self.p[f"u{way}"]
        dx, du = np.zeros_like(self.p[f"x{way}"]), np.zeros_like(u)
        dh = dc = np.zeros((codes.shape[1], self.hidden), np.float32)
        for t in range(len(codes) - 1, -1, -1):
            before, c_before, i, f, o, g, tc = trace[t]
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            np.add.at(dx, codes[t], dz)
            du += before.T @ dz
            dh, dc = dz @ u.T, dc * f
        grads[f"x{way}"], grads[f"u{way}"] = dx, du

    def _emissions(self, codes: np.ndarray, traces: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        both = np.concatenate([
            self._lstm(codes, 0, traces and traces[0]), self._lstm(codes[::-1], 1, traces and traces[1])[::-1],
        ], 2)
        return both, both @ self.p["w"] + self.p["b"]

    def _step(self, codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
        """Mean loss per character and its gradients; codes, gold: (time, batch)."""
        traces: tuple = ([], [])
        both, e = self._emissions(codes, traces)
        t = self.p["t"]
        length, batch, _ = e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        log_sum = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        for s in range(1, length):
            alpha[s] = log_sum(alpha[s - 1][:, :, None] + t, 1) + e[s]
        for s in range(length - 2, -1, -1):
            beta[s] = log_sum(t[None] + (e[s + 1] + beta[s + 1])[:, None, :], 2)
        total = log_sum(alpha[-1], 1)
        marginal = np.exp(alpha + beta - total[None, :, None])
        pair = np.exp(alpha[:-1][:, :, :, None] + t + (e[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None]).sum((0, 1))
        one = np.eye(self.tags, dtype=np.float32)[gold]
        path = (e * one).sum() + t[gold[:-1], gold[1:]].sum()
        scale = 1 / (length * batch)
        de = (marginal - one).astype(np.float32) * np.float32(scale)
        np.subtract.at(pair, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        grads = {"t": pair * scale, "b": de.sum((0, 1)), "w": np.einsum("tbh,tbk->hk", both, de)}
        d_both = de @ self.p["w"].T
        self._back(codes, 0, traces[0], d_both[:, :, : self.hidden], grads)
        self._back(codes[::-1], 1, traces[1], d_both[::-1, :, self.hidden :], grads)
        return float(total.sum() - path) * scale, grads

    def train(self, codes: np.ndarray, gold: np.ndarray, updates: int, batch: int, rate: float, seed: int) -> float:
        """Adam on random batches of (windows, time) codes and tags; the last mean loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        loss = 0.0
        for n in range(1, updates + 1):
            pick = rng.integers(0, len(codes), batch)
            loss, grads = self._step(codes[pick].T, gold[pick].T)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            slow = rate * min(1.0, 4 * (1 - (n - 1) / updates))
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= (slow * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
        return loss

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """(windows, time, tags): what each place of (windows, time) codes says for each tag."""
        return self._emissions(codes.T)[1].transpose(1, 0, 2)

    def best_paths(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tag paths (runs, time) of emissions (runs, time, tags) by the transitions; of each run its first lengths places count."""
        e, t = e.transpose(1, 0, 2), self.p["t"]
        stay = np.arange(self.tags, dtype=np.uint8)
        best, back = e[0], np.empty(e.shape, np.uint8)
        for s in range(1, len(e)):
            ways = best[:, :, None] + t
            on = (s < lengths)[:, None]
            back[s] = np.where(on, ways.argmax(1), stay)
            best = np.where(on, ways.max(1) + e[s], best)
        path = np.empty(e.shape[:2], np.uint8)
        path[-1] = best.argmax(1)
        for s in range(len(e) - 1, 0, -1):
            path[s - 1] = np.take_along_axis(back[s], path[s][:, None].astype(np.int64), 1)[:, 0]
        return path.T

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tag paths of (windows, time) codes, each window by itself."""
        return self.best_paths(self.emissions(codes), np.full(len(codes), codes.shape[1]))
