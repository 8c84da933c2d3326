"""python tools/measure.py [SF_DIR]: figures of the README that no query gives: the packing along the curve, and the field without its skip edges."""
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import numpy as np

from veilspark.session import local_session


def packing(spark, d: str) -> None:
    """Fill, and the range of places on the curve inside a container, as a share of all documents."""
    from pyspark.sql import functions as F

    from veilspark.llm import packing as pk
    from veilspark.llm import queries as q

    sized = pk.sizes(q.p6_ids(spark, d))
    caps = dict(q._capacities(spark, d))
    at = {r.id: i for i, r in enumerate(sized.orderBy("place", F.xxhash64("id")).select("id").collect())}
    for name in caps:
        load, places = {}, {}
        for r in pk.pack(sized, [(name, caps[name])]).collect():
            load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
            places.setdefault(r.container_id, []).append(at[r.doc_id])
        ranges = [(max(p) - min(p)) / len(at) for p in places.values()]
        print(f"{name}: capacity {caps[name]}, {len(load)} containers, fill {sum(load.values()) / len(load) / caps[name]:.4f}, middle range {np.median(ranges):.4f}, 90 % range {np.quantile(ranges, 0.9):.4f}")


def field(spark, d: str) -> None:
    """How many nodes get another label, or other findings come, when kinds of edges are left out or weights stay at their prior."""
    from veilspark.llm import pii

    names = [tuple(r) for r in spark.read.parquet(f"{d}/name_lexicon.parquet").select("name_part", "name_kind").collect()]
    notes = spark.read.parquet(f"{d}/visits.parquet").select("visit_id", "Note").filter("Note <> ''")
    model = pii.fit(names, [r[1] for r in pii.drawn(notes, "visit_id", pii.SAMPLE).collect()])
    texts = [r[0] for r in notes.select("Note").orderBy("visit_id").collect()]
    print({str(k): (round(float(pii.PRIOR[i]), 2), round(float(model.weights[i]), 2)) for k, i in pii.PLACE.items() if abs(model.weights[i] - pii.PRIOR[i]) > 0.02})

    def found(weights, without=()):
        out = set()
        for i in range(0, len(texts), 4000):
            part = texts[i : i + 4000]
            model.weights = weights.copy()
            for e in without:
                model.weights[pii.PLACE["edge", e]] = 0
            out |= {(i + t, s, e, k) for t, s, e, k in pii.analyse(part, model)}
        return out

    fitted = model.weights.copy()
    whole = found(fitted)
    cases = {"prior weights": (pii.PRIOR, ()), "no chain": (fitted, ("chain",)), "no skip edges": (fitted, ("same", "similar", "repeat", "email")), **{f"no edge '{e}'": (fitted, (e,)) for e in ("same", "similar", "repeat", "email")}}
    print(f"{len(texts)} notes, {len(whole)} findings")
    for name, (w, without) in cases.items():
        other = found(w, without)
        print(f"{name}: {len(whole - other)} lost, {len(other - whole)} more")


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    s = local_session()
    packing(s, where)
    field(s, where)
