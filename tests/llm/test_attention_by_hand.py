"""The attention model against a scorer that takes one token at a time, in plain loops, from whole texts."""

import math

import numpy as np

from siftwell.llm import attention as A


def by_hand(p, biases, text):
    """Natural log probability of each token of a text."""
    padded = [A.START] * A.CONTEXT + list(text)
    out = []
    for k, target in enumerate(text):
        # The window that scores this token has CONTEXT + 1 - SCORED tokens before its first target.
        first = k // A.SCORED * A.SCORED - (A.CONTEXT + 1 - A.SCORED)
        seen = [padded[A.CONTEXT + j] for j in range(first, k)]
        vectors = [p["embedding"][t].astype(float) for t in seen]
        q = vectors[-1] @ p["query"] / math.sqrt(A.DIM)
        raw = []
        for j, x in enumerate(vectors):
            key = x @ p["key"] + (vectors[j - 1] @ p["key_before"] if j else 0)
            raw.append(float(q @ key + p["distance"][len(seen) - 1 - j]))
        weights = [math.exp(r - max(raw)) for r in raw]
        weights = [w / sum(weights) for w in weights]
        hidden = np.tanh(sum(w * (x @ p["value"]) for w, x in zip(weights, vectors)) + vectors[-1] @ p["own"])
        mass = biases.classes[seen[-1]] * np.exp(hidden @ p["to_class"])
        of_class = mass[biases.class_of[target]] / mass.sum()
        within = math.exp(-float(biases.members[seen[-1] * A.TOKENS + target]) / A.STEPS)
        gate = 1 / (1 + math.exp(-float(hidden @ p["to_gate"] + p["gate"][0])))
        copied = sum(w for w, t in zip(weights, seen) if t == target)
        out.append(math.log((1 - gate) * of_class * within + gate * copied))
    return out


def fixture():
    chance = np.random.default_rng(3)
    texts = [np.r_[chance.integers(0, 40, n), A.END] for n in (0, 1, 7, A.SCORED - 1, A.SCORED, 3 * A.SCORED + 5)]
    flat = np.concatenate(texts)
    biases = A.Biases(np.r_[A.START, flat[:-1]], flat, np.ones(len(flat), np.float32))
    params = A.initial(biases)
    for name, value in params.items():
        params[name] = value + chance.standard_normal(value.shape).astype(np.float32) * np.float32(0.2)
    return texts, biases, params


def test_scores_equal_a_plain_scorer():
    texts, biases, params = fixture()
    edges = np.r_[0, np.cumsum([len(t) for t in texts])]
    rows, owner, real = A.text_windows(np.concatenate(texts), edges)
    found = A.log_probs(params, biases, rows)
    for k, text in enumerate(texts):
        own = np.concatenate([f[:n] for f, n in zip(found[owner == k], real[owner == k])])
        assert np.allclose(own, by_hand(params, biases, text), atol=2e-3)


def test_very_large_weights_stay_finite():
    texts, biases, params = fixture()
    rows, _, _ = A.text_windows(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])])
    for scale in (30, 300):
        wild = params | {name: params[name] * np.float32(scale) for name in ("query", "key", "to_class")}
        assert np.isfinite(A.log_probs(wild, biases, rows)).all()


def test_gradient_steps_lower_the_loss():
    texts, biases, params = fixture()
    rows, _, _ = A.text_windows(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])])
    trainer = A.Trainer(params, biases, rate=0.02)
    losses = [trainer.batch(rows) for _ in range(20)]
    assert losses[-1] < losses[0] and np.isfinite(losses).all()


def test_gradients_equal_differences():
    """One Adagrad step from zero moves each weight against the sign of its gradient; differences of the loss give the same signs."""
    texts, biases, params = fixture()
    rows, _, _ = A.text_windows(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])])
    trainer = A.Trainer(params, biases, rate=1e-4)
    trainer.batch(rows)
    real = rows[:, A.CONTEXT + 1 - A.SCORED :] != A.START

    def loss(changed):
        return -A.log_probs(changed, biases, rows).astype(float)[real].mean()

    for name in ("query", "key", "key_before", "value", "own", "to_class", "to_gate", "gate", "distance"):
        step = params[name] - trainer.params[name]
        at = np.unravel_index(np.abs(step).argmax(), step.shape)
        up, down = ({**params, name: params[name].copy()} for _ in range(2))
        up[name][at] += np.float32(0.02)
        down[name][at] -= np.float32(0.02)
        assert np.sign(loss(up) - loss(down)) == np.sign(step[at]), name


def test_batches_share_their_memory():
    """Batch after batch works in the same arrays, and smaller or larger ones between give the same numbers as alone."""
    texts, biases, params = fixture()
    rows, _, _ = A.text_windows(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])])
    alone = [A.Pass(params, biases, rows[:n], A.Room()).chance.copy() for n in (2, len(rows), 1)]
    room = A.Room()
    for n, want in zip((2, len(rows), 1), alone):
        assert np.allclose(A.Pass(params, biases, rows[:n], room).chance, want, rtol=1e-4)
    A.Pass(params, biases, rows, room)
    held = {name: id(array) for name, array in room.held.items()}
    A.Pass(params, biases, rows, room)
    assert held == {name: id(array) for name, array in room.held.items()}
    assert biases.classes.flags.c_contiguous


def test_only_embeddings_that_occur_change():
    texts, biases, params = fixture()
    rows, _, _ = A.text_windows(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])])
    trainer = A.Trainer(params, biases)
    trainer.batch(rows)
    changed = np.flatnonzero((trainer.params["embedding"] != params["embedding"]).any(axis=1))
    assert set(changed) <= set(rows[:, : A.CONTEXT].reshape(-1).tolist()) and len(changed) > 30
