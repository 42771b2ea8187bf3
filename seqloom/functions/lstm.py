"""One recurrent layer and a linear output per step: the arithmetic inside a training task.

Cell after Hochreiter & Schmidhuber (1997) with a forget gate, initial values
after Glorot & Bengio (2010), optimizer after Kingma & Ba (2015). Parameters
travel between Spark and a task as one flat float32 vector.
"""

import numpy as np

# Optimizer constants of the paper.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8


def layout(dim: int, hidden: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """``(layer, name, shape)`` in the order of the flat vector."""
    return [
        (0, "input_weight", (dim, 4 * hidden)),
        (0, "recurrent_weight", (hidden, 4 * hidden)),
        (0, "bias", (4 * hidden,)),
        (1, "weight", (hidden, dim)),
        (1, "bias", (dim,)),
    ]


def size(dim: int, hidden: int) -> int:
    return sum(int(np.prod(shape)) for _, _, shape in layout(dim, hidden))


def split(flat: np.ndarray, dim: int, hidden: int) -> list[np.ndarray]:
    """Views on the flat vector, in layout order."""
    views, at = [], 0
    for _, _, shape in layout(dim, hidden):
        n = int(np.prod(shape))
        views.append(flat[at : at + n].reshape(shape))
        at += n
    return views


def initial(dim: int, hidden: int, seed: int) -> np.ndarray:
    """Normal weights with variance 2/(in+out), zero biases, forget gate open."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(size(dim, hidden), dtype=np.float32)
    w, u, b, v, _ = split(flat, dim, hidden)
    w[:] = rng.normal(0.0, np.sqrt(2.0 / (dim + hidden)), w.shape)
    u[:] = rng.normal(0.0, np.sqrt(2.0 / (hidden + hidden)), u.shape)
    v[:] = rng.normal(0.0, np.sqrt(2.0 / (hidden + dim)), v.shape)
    b[hidden : 2 * hidden] = 1.0
    return flat


class Scratch:
    """Arrays reused from batch to batch: fresh large ones cost more than the arithmetic."""

    def __init__(self):
        self._held = {}

    def take(self, name, shape, dtype):
        cells = int(np.prod(shape))
        held = self._held.get(name)
        if held is None or held.size < cells or held.dtype != dtype:
            held = self._held[name] = np.empty(cells, dtype=dtype)
        return held[:cells].reshape(shape)


def _run(flat, x, hidden, scratch):
    """Outputs ``[T, n, D]`` and what the backward pass needs. Time comes first inside."""
    n, steps, dim = x.shape
    w, u, b, v, d = split(flat, dim, hidden)
    x = np.ascontiguousarray(x.transpose(1, 0, 2)).reshape(steps * n, dim)
    # i, f and o are logistic, 1/(1+exp(-z)); g is tanh, written over the gate inputs.
    gates = scratch.take("gates", (steps, n, 4 * hidden), flat.dtype)
    np.matmul(x, w, out=gates.reshape(steps * n, 4 * hidden))
    gates += b
    h = scratch.take("h", (steps + 1, n, hidden), flat.dtype)
    c = scratch.take("c", (steps + 1, n, hidden), flat.dtype)
    h[0], c[0] = 0.0, 0.0
    squashed = scratch.take("squashed", (steps, n, hidden), flat.dtype)
    for t in range(steps):
        z = gates[t]
        z += h[t] @ u
        logistic, g = z[:, : 3 * hidden], z[:, 3 * hidden :]
        np.exp(-np.clip(logistic, -60.0, 60.0), out=logistic)
        logistic += 1.0
        np.reciprocal(logistic, out=logistic)
        np.tanh(g, out=g)
        np.multiply(z[:, hidden : 2 * hidden], c[t], out=c[t + 1])
        c[t + 1] += z[:, :hidden] * g
        np.tanh(c[t + 1], out=squashed[t])
        np.multiply(z[:, 2 * hidden : 3 * hidden], squashed[t], out=h[t + 1])
    out = (h[1:].reshape(steps * n, hidden) @ v + d).reshape(steps, n, dim)
    return out, x, gates, h, c, squashed


def predict(flat: np.ndarray, x: np.ndarray, hidden: int, rows: int = 64) -> np.ndarray:
    """``[n, T, D]`` outputs, a cache-sized piece at a time."""
    out = np.empty(x.shape, dtype=flat.dtype)
    scratch = Scratch()
    for at in range(0, len(x), rows):
        piece = _run(flat, x[at : at + rows], hidden, scratch)[0]
        out[at : at + rows] = piece.transpose(1, 0, 2)
    return out


def loss_and_gradient(flat, x, y, hidden, scratch=None):
    """Mean over rows of the squared error per dimension, summed over steps.

    ``x`` is ``[n, T, D]``; ``y`` is ``[n, D]``, the target of every step, or ``[n, T, D]``, one for each.
    """
    n, steps, dim = x.shape
    y = y.transpose(1, 0, 2) if y.ndim == 3 else y
    scratch = scratch or Scratch()
    out, x, gates, h, c, squashed = _run(flat, x, hidden, scratch)
    _, u, _, v, _ = split(flat, dim, hidden)
    grad = scratch.take("grad", flat.shape, flat.dtype)
    gw, gu, gb, gv, gd = split(grad, dim, hidden)
    error = (out - y).reshape(steps * n, dim)
    loss = float(np.vdot(error, error)) / (n * dim)
    dout = error * flat.dtype.type(2.0 / (n * dim))
    np.matmul(h[1:].reshape(steps * n, hidden).T, dout, out=gv)
    np.sum(dout, axis=0, out=gd)
    back = (dout @ v.T).reshape(steps, n, hidden)
    dz = scratch.take("dz", gates.shape, flat.dtype)
    dh = np.zeros((n, hidden), dtype=flat.dtype)
    dc = np.zeros((n, hidden), dtype=flat.dtype)
    for t in reversed(range(steps)):
        i, f, o, g = np.split(gates[t], 4, axis=1)
        dh += back[t]
        dc += dh * o * (1.0 - squashed[t] * squashed[t])
        dz[t, :, :hidden] = dc * g * i * (1.0 - i)
        dz[t, :, hidden : 2 * hidden] = dc * c[t] * f * (1.0 - f)
        dz[t, :, 2 * hidden : 3 * hidden] = dh * squashed[t] * o * (1.0 - o)
        dz[t, :, 3 * hidden :] = dc * i * (1.0 - g * g)
        dh = dz[t] @ u.T
        dc *= f
    flat_dz = dz.reshape(steps * n, 4 * hidden)
    np.matmul(x.T, flat_dz, out=gw)
    np.matmul(h[:-1].reshape(steps * n, hidden).T, flat_dz, out=gu)
    np.sum(flat_dz, axis=0, out=gb)
    return loss, grad


def adam_step(flat, grad, m, v, step, rate, scratch=None):
    """Updates the three vectors in place and returns what was taken off ``flat``."""
    one = flat.dtype.type
    scratch = scratch or Scratch()
    change = scratch.take("change", flat.shape, flat.dtype)
    root = scratch.take("root", flat.shape, flat.dtype)
    np.subtract(grad, m, out=change)
    change *= one(1.0 - BETA1)
    m += change
    np.multiply(grad, grad, out=change)
    change -= v
    change *= one(1.0 - BETA2)
    v += change
    np.sqrt(v, out=root)
    root *= one(1.0 / np.sqrt(1.0 - BETA2**step))
    root += one(EPSILON)
    np.divide(m, root, out=change)
    change *= one(rate / (1.0 - BETA1**step))
    flat -= change
    return change
