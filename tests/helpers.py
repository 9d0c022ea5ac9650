import numpy as np

SF = "/root/testdata/sf0.001"


def vectors_of(spark, rows):
    """[(idx, cid, [..])] -> (idx, uid, cid, embedding)."""
    data = [(int(i), int(i), int(c), [float(x) for x in v]) for i, c, v in rows]
    return spark.createDataFrame(data, "idx long, uid long, cid int, embedding array<float>")


def brute_scores(cids, vectors):
    """max(0, highest dot with an earlier row of the same cluster); rows in index order."""
    sims = vectors.astype(np.float64) @ vectors.astype(np.float64).T
    out = []
    for j in range(len(cids)):
        earlier = [sims[i, j] for i in range(j) if cids[i] == cids[j]]
        out.append(max([0.0, *earlier]))
    return np.array(out)


def random_unit(rng, n, d):
    v = rng.normal(size=(n, d))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def collected(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
