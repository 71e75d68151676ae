"""Brute-force helpers."""


def as_set(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def partition(n, links):
    """Smallest member of each one's component."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
