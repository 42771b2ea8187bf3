"""Plain versions that operators are held against."""


def groups(nodes, links):
    """The smallest node reachable from each node."""
    root = {k: k for k in nodes}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {k: top(k) for k in root}
