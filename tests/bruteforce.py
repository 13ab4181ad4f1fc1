"""A direct, slow density clustering to compare with: every pair, no blocks, no collapse."""

import math


def clusters(points, min_size=3, min_samples=2, epsilon=0.1, digits=9):
    """Sets of member ids; ``points`` maps id to vector."""
    ids = sorted(points)
    n = len(ids)
    dist = {
        (a, b): round(math.dist(points[a], points[b]), digits) for a in ids for b in ids if a != b
    }
    core = {}
    for a in ids:
        others = sorted(dist[a, b] for b in ids if b != a)
        core[a] = others[min(min_samples, n - 1) - 1]
    edges = sorted(
        (max(core[a], core[b], dist[a, b]), dist[a, b], a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
    )
    # Single linkage: every merge makes a node (children, weight).
    node = {a: a for a in ids}
    comp = {a: {a} for a in ids}
    children, weight, leaves_of = {}, {}, {a: {a} for a in ids}
    fresh = max(ids) + 1
    total = 0.0
    for w, _, a, b in edges:
        x, y = node[a], node[b]
        if x == y:
            continue
        total += w
        children[fresh], weight[fresh] = (x, y), w
        leaves_of[fresh] = leaves_of[x] | leaves_of[y]
        for p in leaves_of[fresh]:
            node[p] = fresh
        fresh += 1
    root = fresh - 1
    # Condense: walk down, dropping small sides; remember clusters with birth and parent.
    found = []  # (members, birth, parent index)

    def condense(top, birth, parent):
        me = len(found)
        found.append([leaves_of[top], birth, parent, True])
        at = top
        while at in children:
            x, y = children[at]
            big = [c for c in (x, y) if len(leaves_of[c]) >= min_size]
            if len(big) == 2:
                found[me][3] = False
                for c in big:
                    condense(c, weight[at], me)
                return
            if not big:
                return
            at = big[0]

    if n >= 2:
        condense(root, math.inf, None)
    chosen = set()
    for k, (_, birth, parent, leaf) in enumerate(found):
        if not leaf or parent is None:
            continue
        at = k
        if birth < epsilon:
            while found[at][2] != 0 and found[at][1] < epsilon:
                at = found[at][2]
        chosen.add(at)
    return {frozenset(found[k][0]) for k in chosen}, total
