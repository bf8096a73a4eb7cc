"""Largest eigenvalues of a symmetric positive semidefinite operator that is known by its products only.

Block Jacobi-Davidson: Rayleigh-Ritz in a growing subspace; for every wanted Ritz pair a correction equation, projected
on what is orthogonal to the locked vectors and the wanted Ritz vectors, solved by a few steps of MINRES; pairs whose
residual has reached double precision are locked. The equations of all pairs advance in step, so one product with a
block of vectors serves them all. Everything here has the size of a few vectors; the product is the caller's.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]

INNER_STEPS = 8
INNER_TOLERANCE = 0.05
LARGEST_BASIS = 64
RESIDUAL = 32 * np.finfo(float).eps
ROUNDING_FLOOR = 1e-12
MOST_ROUNDS = 300


def minres(product: Product, shifts: np.ndarray, off: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int = INNER_STEPS) -> np.ndarray:
    """Approximate solutions of off (A - shift) off x = rhs, a column each; the columns advance in step."""
    size = np.linalg.norm(rhs, axis=0)
    live = size > 0
    beta = np.where(live, size, 1.0)
    v, v_before = rhs / beta, np.zeros_like(rhs)
    w, w_before, x = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    eta = np.where(live, size, 0.0)
    cos, cos_before, sin, sin_before = np.ones_like(size), np.ones_like(size), np.zeros_like(size), np.zeros_like(size)
    for _ in range(steps):
        image = off(product(v) - v * shifts)
        alpha = np.einsum("ij,ij->j", v, image)
        ahead = image - v * alpha - v_before * beta
        length = np.linalg.norm(ahead, axis=0)
        delta = cos * alpha - cos_before * sin * beta
        first = np.hypot(delta, length)
        second = sin * alpha + cos_before * cos * beta
        third = sin_before * beta
        live = live & (first > 0)
        first = np.where(live, first, 1.0)
        w, w_before = np.where(live, (v - w_before * third - w * second) / first, 0.0), w
        cos, cos_before, sin, sin_before = delta / first, cos, length / first, sin
        x = x + np.where(live, cos * eta, 0.0) * w
        eta = -sin * eta
        live = live & (length > 0) & (np.abs(eta) > INNER_TOLERANCE * size)
        if not live.any():
            break
        v, v_before, beta = ahead / np.where(length > 0, length, 1.0), v, length
    return x


def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """What the new columns add to the orthonormal columns `against`."""
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if size == 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - against @ (against.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept.append(column)
    return np.array(kept).T if kept else np.empty((len(against), 0))


def largest_eigenpairs(product: Product, dimension: int, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns), all residuals at double precision.

    The largest entry of an eigenvector is positive. Of a multiple eigenvalue some orthonormal vectors are returned.
    """
    wanted = min(wanted, dimension)
    random = np.random.default_rng(seed)
    locked, values = np.empty((dimension, 0)), np.empty(0)
    basis = _orthonormal(random.standard_normal((dimension, min(dimension, wanted + 4))), locked)
    images = product(basis)
    best = np.inf
    for _ in range(MOST_ROUNDS):
        inner = basis.T @ images
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz, ritz_images = basis @ turn, images @ turn
        residuals = ritz_images - ritz * theta
        norms = np.linalg.norm(residuals, axis=0)
        scale = max(theta[0] if len(theta) else 0.0, values.max(initial=0.0), np.finfo(float).tiny)
        whole = len(theta) + len(values) == dimension  # the subspace is everything: only rounding is left
        missing = max(0, wanted - len(values))
        front = int(norms[: max(missing, 1)].argmax()) if len(norms) else 0
        stuck = len(norms) > 0 and ROUNDING_FLOOR * scale >= norms[front] >= best / 2
        best = norms[front] if len(norms) else 0.0
        done = 0
        while done < missing and done < len(theta) and (norms[done] <= RESIDUAL * scale or whole or stuck):
            done += 1
        if done:
            locked = np.column_stack([locked, ritz[:, :done]])
            values = np.append(values, theta[:done])
            best = np.inf
        theta, ritz, ritz_images, residuals = theta[done:], ritz[:, done:], ritz_images[:, done:], residuals[:, done:]
        missing = wanted - len(values)
        # finished once nothing outside is larger than what is locked
        if missing == 0 and (not len(theta) or theta[0] <= values.min() * (1 + RESIDUAL)):
            break
        if missing == 0:
            worst = int(values.argmin())
            locked, values, missing = np.delete(locked, worst, axis=1), np.delete(values, worst), 1
        block = min(missing, len(theta))
        guarded = np.column_stack([locked, ritz[:, :block]])

        def off(x: np.ndarray) -> np.ndarray:
            return x - guarded @ (guarded.T @ x)

        found = minres(product, theta[:block], off, -off(residuals[:, :block]))
        if ritz.shape[1] + block > LARGEST_BASIS:
            keep = min(ritz.shape[1], max(LARGEST_BASIS // 2, 2 * wanted))
            ritz, ritz_images = ritz[:, :keep], ritz_images[:, :keep]
        added = _orthonormal(found, np.column_stack([locked, ritz]))
        if not added.shape[1]:
            added = _orthonormal(random.standard_normal((dimension, 2)), np.column_stack([locked, ritz]))
        basis, images = ritz, ritz_images
        if added.shape[1]:
            basis, images = np.column_stack([basis, added]), np.column_stack([images, product(added)])
    else:
        raise RuntimeError(f"no convergence in {MOST_ROUNDS} rounds")
    order = np.argsort(-values, kind="stable")[:wanted]
    values, locked = values[order], locked[:, order]
    signs = np.sign(locked[np.abs(locked).argmax(axis=0), np.arange(len(values))])
    return values, locked * signs
