"""Sequential folds over an ordered array that stay near-linear in its length."""

from __future__ import annotations


def running_values(items: str, var: str, value: str, value_type: str, state: dict[str, str], step: dict[str, str]) -> str:
    """Return SQL for an array with one ``value`` per item of the column ``items``.

    ``state`` gives what is carried along and its start, ``step`` how each item changes it; ``value`` and ``step`` may use the
    item as ``var`` and the state as ``acc``. Values are gathered in chunks of about the square root of the length and joined
    once, since every append copies the array it appends to.
    """
    none = f"cast(array() AS array<{value_type}>)"
    width = f"greatest(cast(ceil(sqrt(size({items}))) AS int), 1)"
    chunks = f"transform(sequence(0, (size({items}) + {width} - 1) div {width}), c -> slice({items}, cast(c AS int) * {width} + 1, {width}))"
    inner_start = ", ".join(f"'{k}', outer_acc.last.{k}" for k in state)
    moved = ", ".join(f"'{k}', {v}" for k, v in step.items())
    inner = (
        f"aggregate(chunk, named_struct('made', {none}, {inner_start}), "
        f"(acc, {var}) -> named_struct('made', concat(acc.made, array({value})), {moved}))"
    )
    start = ", ".join(f"'{k}', {v}" for k, v in state.items())
    return (
        f"aggregate({chunks}, named_struct('all', cast(array() AS array<array<{value_type}>>), 'last', named_struct('made', {none}, {start})), "
        f"(outer_acc, chunk) -> named_struct('all', concat(outer_acc.all, array(outer_acc.last.made)), 'last', {inner}), "
        f"outer_acc -> flatten(concat(outer_acc.all, array(outer_acc.last.made))))"
    )
