"""Groups of linked ids, worked out plainly."""


def root_of(pairs):
    """Smallest member of each node's component, by plain union-find."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}
