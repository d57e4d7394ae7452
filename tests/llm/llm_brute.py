"""Brute-force forms that more than one test module compares with."""


def brute(rows):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in range(len(rows)) if rows[i][0] is not None and sets[i]]
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if 100 * min(len(sets[a]), len(sets[b])) >= 85 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    low = {}
    for a in range(len(rows)):
        if rows[a][0] is not None:
            low[find(a)] = min(low.get(find(a), rows[a][0]), rows[a][0])
    return sorted(((rows[a][0], len(sets[a]), low.get(find(a))) for a in range(len(rows))), key=str)
