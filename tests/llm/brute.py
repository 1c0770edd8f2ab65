"""Plain-Python versions that the operators are held against."""

from collections import Counter, defaultdict

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(text, k):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*(w[j:] for j in range(k))))


def near_components(docs, k, percent):
    """id -> (set size, least id linked), by an exact prefix-filtered join over distinct sets."""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first = {}
    for i in sorted(sets):
        if sets[i]:
            parent[i] = first.setdefault(sets[i], i)
    common, having = Counter(x for s in first for x in s), defaultdict(list)
    for s, i in first.items():
        rare = sorted(s, key=lambda x: (common[x], x))[:len(s) - -(-percent * len(s) // 100) + 1]
        near = {j for x in rare for j in having[x]}
        for x in rare:
            having[x].append(i)
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in docs}


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def duck_rows(folder, sql):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
