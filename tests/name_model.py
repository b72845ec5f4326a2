"""Brute-force counterparts of the similarity operators, for small inputs."""


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        following = [0]
        for j, y in enumerate(b):
            following.append(row[j] + 1 if x == y else max(following[j], row[j + 1]))
        row = following
    return row[-1]


def score(a, b):
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared = len(" ".join(sorted(left & right)))
    only_a, only_b = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if shared and (not only_a or not only_b):
        return 100.0
    gap = 1 if shared else 0
    full_a, full_b = shared + gap + len(only_a), shared + gap + len(only_b)
    best = 100 - 100 * (len(only_a) + len(only_b) - 2 * lcs(only_a, only_b)) / (full_a + full_b)
    if shared:
        best = max(best, 100 - 100 * (gap + len(only_a)) / (shared + full_a), 100 - 100 * (gap + len(only_b)) / (shared + full_b))
    return best


def pairs(names, threshold):
    names = sorted(set(names))
    return {
        (a, b): s for i, a in enumerate(names) for b in names[i + 1:] if (s := score(a, b)) >= threshold
    }


def clusters(names, threshold):
    parent = {n: n for n in names}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs(names, threshold):
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in names}
