"""The batch planner: a warm-up schedule under a cap for each domain.

Rows are ranked in their domain's queue by a window. What follows needs only each domain's length, so one small group
for each (role, band, tier), 30 at most, works out how many contacts each batch takes of each domain. A group's input is
a row for each domain, its output one for each domain and batch; runs of places become places, and meet contacts, on
Spark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.scalars import geo_band, is_role_inbox
from ..operators.read import sendable_pool

STEP, CAP, FLOOR, SWALLOW, STRICT, WARM, CEILING = 50, 250, 50, 10, 5, 3, 12


def target(i: int, ramp: list[int] | None) -> int:
    return (ramp[i] if i < len(ramp) else ramp[-1]) if ramp else min((i + 1) * STEP, CAP)


def schedule(lengths: list[int], ramp: list[int] | None = None, strict: int = STRICT) -> list[dict[int, int]]:
    """Batches as contacts taken of each domain (its number in `lengths`); a domain's contacts go in order of its queue.

    A batch goes round the domains in their order, one contact of each a round, until it is full. As every domain that
    has contacts left gives at least one, only the first `goal` of these matter; they are filled as levels rise.
    """
    left, head, behind, batches = list(lengths), [], 0, []
    while True:
        goal, cap = target(len(batches), ramp), strict if len(batches) < WARM else 2 * strict
        while len(head) < goal and behind < len(left):
            if left[behind] > 0:
                head.append(behind)
            behind += 1
        first = head[:goal]
        room = np.minimum(cap, np.array([left[d] for d in first], np.int64))
        level = max((r for r in range(cap + 1) if np.minimum(room, r).sum() <= goal), default=0)
        taken = np.minimum(room, level)
        more = np.flatnonzero(room > level)[: goal - int(taken.sum())]
        taken[more] += 1
        batch = {d: int(n) for d, n in zip(first, taken, strict=True) if n}
        if not batch:
            break
        for d, n in batch.items():
            left[d] -= n
        head = [d for d in head if left[d]]
        batches.append(batch)
    while len(batches) > 1 and sum(batches[-1].values()) < FLOOR:  # fold a short tail, as far as domains allow
        last, rest = batches.pop(), {}
        for d, n in last.items():
            moved = min(n, max(0, CEILING - batches[-1].get(d, 0)))
            if moved:
                batches[-1][d] = batches[-1].get(d, 0) + moved
            if n > moved:
                rest[d] = n - moved
        if rest:
            batches.append(rest)
            break
    while len(batches) > 1 and sum(batches[-1].values()) < SWALLOW:
        for d, n in batches.pop().items():
            batches[-1][d] = batches[-1].get(d, 0) + n
    return batches


def plan_batches(contacts: DataFrame, include_inferred: bool = False, ramp: list[int] | None = None, strict: int = STRICT) -> DataFrame:
    """contacts with export_batch and send_group planned anew; whatever was planned before is cleared."""
    pool = sendable_pool(contacts, include_inferred).select("id", "confidence", is_role_inbox(F.col("email")).alias("role"), F.coalesce("email_domain", F.lit("?")).alias("domain"), F.coalesce("proximity_tier", F.lit("T4")).alias("tier"))
    pool = pool.withColumn("band", geo_band(F.col("domain")))
    # the order of groups, real people before shared inboxes; tiers that are none of the five are never planned
    place = F.coalesce(*[F.when((F.col("band") == b) & (F.col("tier") == t), F.lit(i)) for i, (b, t) in enumerate(vocab.BAND_TIERS)])
    pool = pool.withColumn("grp", place + F.when(F.col("role"), 15).otherwise(0)).filter("grp is not null")
    queue = Window.partitionBy("grp", "domain").orderBy(F.when(F.col("confidence") == "direct", 0).otherwise(1), "id")
    pool = pool.withColumn("pos", F.row_number().over(queue) - 1)
    domains = pool.groupBy("grp", "domain").agg(F.count("*").alias("n"), F.min("id").alias("first"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "first"], ascending=[False, True])
        names, grp, taken, runs = rows["domain"].tolist(), int(rows["grp"].iloc[0]), [0] * len(rows), []
        for k, batch in enumerate(schedule(rows["n"].astype(int).tolist(), ramp, strict)):
            for d, n in batch.items():
                runs.append((grp, names[d], taken[d], taken[d] + n - 1, k + 1))
                taken[d] += n
        return pd.DataFrame(runs, columns=["grp", "domain", "a", "b", "k"])

    runs = domains.groupBy("grp").applyInPandas(run, "grp int, domain string, a int, b int, k int")
    placed = pool.join(runs.select("grp", "domain", "k", F.explode(F.sequence("a", "b")).alias("pos")), ["grp", "domain", "pos"])
    # batches are numbered over all groups: a group's come behind those of the groups before it, 30 at most
    sizes = placed.groupBy("grp").agg(F.max("k").alias("batches"))
    numbers = sizes.select("grp", (F.sum("batches").over(Window.orderBy("grp")) - F.col("batches")).alias("earlier"))
    label = F.create_map(*[F.lit(x) for kv in vocab.TIER_LABELS.items() for x in kv])
    group = F.concat(F.when(F.col("role"), "ROLE-").otherwise(""), "band", F.lit("-"), F.element_at(label, F.col("tier")), F.lit("-B"), F.lpad(F.col("k").cast("string"), 2, "0"))
    new = placed.join(F.broadcast(numbers), "grp").select("id", (F.col("earlier") + F.col("k")).cast("int").alias("export_batch"), group.alias("send_group"))
    return contacts.drop("export_batch", "send_group").join(new, "id", "left").select(*contacts.columns)
