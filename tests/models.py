"""Plain definitions of the pair and thread results, for small inputs.

A comment is a dict with pos, id, parent_id, body. Each function states what the
result is for a row by looking at all rows, not how a stream would find it.
"""


def key(parent_id):
    return None if parent_id is None else parent_id.partition("_")[2] if "_" in parent_id else parent_id


def is_reply(c):
    return c["parent_id"] is not None and "_c" in c["parent_id"]


def latest(rows, cid, before, inclusive):
    """The row with that id at the greatest position up to ``before``."""
    at = [r for r in rows if cid is not None and r["id"] == cid
          and (r["pos"] < before or inclusive and r["pos"] == before)]
    return max(at, key=lambda r: r["pos"], default=None)


def with_parent(rows, parent_key, inclusive):
    """(child, parent) for the children that have one."""
    found = ((c, latest(rows, parent_key(c), c["pos"], inclusive)) for c in rows)
    return [(c, p) for c, p in found if p is not None]


def list_pairs(rows):
    return [(c["id"], key(c["parent_id"])) for c in rows if is_reply(c)]


def verified_pairs(rows):
    """parent_id holds the parent's key here and in the next two."""
    return [(c["id"], c["parent_id"]) for c, _ in with_parent(rows, lambda c: c["parent_id"], False)]


def body_pairs(rows):
    return [(p["body"], c["body"]) for c, p in with_parent(rows, lambda c: c["parent_id"], True)]


def two_phase(rows):
    known = {i for pair in verified_pairs(rows) for i in pair}
    return body_pairs([c for c in rows if c["id"] in known])


def record_pairs(rows):
    replies = [c for c in rows if is_reply(c)]
    return [(c["pos"], p["pos"]) for c, p in with_parent(replies, lambda c: key(c["parent_id"]), True)]


def conversations(rows):
    """(pos, root position, level) in display order. A row's parent is the first
    row with the parent's id; its root is the smallest of itself and the rows
    above it; the display sorts by the positions on the way down from the root."""
    first = {}
    for r in sorted(rows, key=lambda r: r["pos"]):
        if r["id"] is not None:
            first.setdefault(r["id"], r["pos"])
    up = {r["pos"]: first.get(key(r["parent_id"])) for r in rows}

    def above(pos):
        seen = []
        while pos is not None and pos not in seen:
            seen.append(pos)
            pos = up[pos]
        return seen

    root = {pos: min(above(pos)) for pos in up}

    def way(pos):
        steps = above(pos)
        return steps[:steps.index(root[pos]) + 1][::-1]

    return [(p, root[p], len(way(p)) - 1) for p in sorted(up, key=way)]


def first_positions(sentences):
    """word -> (index, count): the index is the word's rank by first place."""
    places = [(w, (i, j)) for i, s in enumerate(sentences) for j, w in enumerate(s)]
    first = {w: min(p for x, p in places if x == w) for w in {w for w, _ in places}}
    return {w: (sorted(first.values()).index(at), sum(x == w for x, _ in places)) for w, at in first.items()}
