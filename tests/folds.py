"""Record-by-record versions of the operators, for comparison on small inputs."""

from __future__ import annotations


def fold_changes(table, changes, apply_reads=False):
    """``table`` maps id to row; ``changes`` are (op, before, after) in order."""
    table = dict(table)
    for op, before, after in changes:
        if op in ("u", "d"):
            table.pop(before["id"], None)
        if op in ("c", "u") or (op == "r" and apply_reads):
            table.setdefault(after["id"], after)
    return table


def fold_upserts(table, rows):
    """``rows`` are (id, row or None) in order."""
    table = dict(table)
    for key, row in rows:
        if row is None:
            table.pop(key, None)
        else:
            table[key] = row
    return table


def fold_changelog(rows, table=None, emit_unchanged=True):
    """Changelog of (seq, id, row or None) in order."""
    table, log = dict(table or {}), []
    for seq, key, row in rows:
        old = table.get(key)
        if row is None:
            if old is not None:
                log.append((seq, 0, "-D", old))
                del table[key]
        elif old is None:
            log.append((seq, 0, "+I", row))
            table[key] = row
        else:
            if emit_unchanged or old != row:
                log.append((seq, 0, "-U", old))
                log.append((seq, 1, "+U", row))
            table[key] = row
    return log


def fold_runs(offsets):
    """(offset, run) of the distinct offsets of one partition."""
    return [(o, o - rank) for rank, o in enumerate(sorted(set(offsets)), start=1)]
