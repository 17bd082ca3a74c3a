"""Named queries over the given tables, with equivalent SQL where SQL can express them."""

from __future__ import annotations


def _modules():
    from namesieve.registry import evaluation, modelling, resolution, risk

    return (resolution, risk, evaluation, modelling)


def registered() -> dict:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
