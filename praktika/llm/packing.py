"""Documents of uneven length in containers of fixed capacity."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from praktika.operators.lineage import cut

CAPACITY = 4096
#: Cost of a token by itself and of a pair of tokens that attend to each other within one document.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Containers that one task fills; items are spread over tasks by hash, so each sees the same mixture.
CONTAINERS_PER_TASK = 2_000
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("praktika", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of a text under the byte-level vocabulary at ``path``; null stays null."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer(path).encode_ordinary
        for batch in batches:
            yield batch.map(lambda t: len(encode(t)), na_action="ignore").astype("Int64")

    return count(text)


def cost(size: int) -> float:
    """What attending over a document of so many tokens costs: a linear and a quadratic part."""
    return LINEAR * size + QUADRATIC * size * size


def pack(sizes: list[int], capacity: int) -> list[int]:
    """A container for each item, by descending size: the one of least cost among those with room, then a new one.

    There are as many containers as the tokens need at least; as the costs are level, long documents are spread and
    short ones fill up. What fits nowhere opens a container. A tree over the room left holds the cheapest container of
    every range of it, so the least cost is found exactly, in as many steps as the capacity has bits.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    where = [-1] * len(sizes)
    count = max(1, -(-sum(sizes) // capacity)) if sizes else 0
    room, spent = [capacity] * count, [0.0] * count
    width = 1 << capacity.bit_length()
    none = (float("inf"), -1)
    heaps: dict[int, list[tuple[float, int]]] = {capacity: [(0.0, c) for c in range(count)]}  # by room
    least = [none] * (2 * width)

    def settle(left: int) -> None:
        k = width + left
        least[k] = heaps[left][0] if heaps[left] else none
        while k > 1:
            k >>= 1
            least[k] = min(least[2 * k], least[2 * k + 1])

    if count:
        settle(capacity)
    for i in order:
        found, low, high = none, width + sizes[i], 2 * width
        while low < high:
            if low & 1:
                found, low = min(found, least[low]), low + 1
            if high & 1:
                high -= 1
                found = min(found, least[high])
            low, high = low >> 1, high >> 1
        chosen = found[1]
        if chosen < 0:
            chosen = len(room)
            room.append(capacity)
            spent.append(0.0)
        else:
            heapq.heappop(heaps[room[chosen]])
            settle(room[chosen])
        room[chosen] -= sizes[i]
        spent[chosen] += cost(sizes[i])
        heapq.heappush(heaps.setdefault(room[chosen], []), (spent[chosen], chosen))
        settle(room[chosen])
        where[i] = chosen
    return where


def pack_items(df: DataFrame, item: str, size: str, capacity: int = CAPACITY, containers_per_task: int = CONTAINERS_PER_TASK) -> DataFrame:
    """Each item's container and place in it.

    An item above the capacity is split into full containers and a rest; no other is. What is left is dealt out by
    hash over tasks of a bounded number of containers, so that each packs a like mixture and none sees all items.
    Within a task items go in descending order to the container of least attention cost with room. Containers that are
    left less than half full are emptied and their items dealt and packed once more, whatever the number of tasks, so
    that no task's rest stays open.

    Rows with a null item or a size that is null or below one are no items; repeated rows count once; ties go by
    item; an empty table gives none; other columns are ignored.
    Out: ``item``, ``part`` (0 for a whole item), ``container`` (string), ``start`` (token in the container), ``size``.
    """
    # the sizes may have cost a pass over all texts: they are kept, not counted anew for each use
    items = cut(df.select(F.col(item).alias("item"), F.col(size).cast("bigint").alias("size")).where("item is not null and size >= 1").distinct())
    full = items.where(F.col("size") > capacity).select(
        "item", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("size") / capacity) - 1).cast("int"))).alias("part"), F.col("size").alias("whole")
    )
    full = full.select("item", (F.col("part") + 1).alias("part"), F.least(F.lit(capacity), F.col("whole") - F.col("part") * capacity).cast("bigint").alias("size"))
    loose = items.where(F.col("size") <= capacity).select("item", F.lit(0).alias("part"), "size").unionByName(full.where(F.col("size") < capacity))
    done = full.where(F.col("size") == capacity).select("item", "part", F.concat_ws("-", F.lit("full"), F.col("item").cast("string"), F.col("part").cast("string")).alias("container"), F.lit(0).cast("bigint").alias("start"), "size")
    schema = f"item {df.schema[item].dataType.simpleString()}, part int, container string, start bigint, size bigint, used bigint"

    def filled(rows: DataFrame, name: str) -> DataFrame:
        """``rows`` dealt by hash over as many tasks as their tokens need, each task's packed."""
        total = rows.agg(F.sum("size")).first()[0] or 0
        tasks = max(1, -(-total // (capacity * containers_per_task)))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "item", "part"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
            pdf["container"] = pack(pdf["size"].tolist(), capacity)
            pdf["start"] = pdf.groupby("container")["size"].cumsum() - pdf["size"]
            pdf["used"] = pdf.groupby("container")["size"].transform("sum")
            pdf["container"] = name + "-" + pdf["task"].astype(str) + "-" + pdf["container"].astype(str)
            return pdf[["item", "part", "container", "start", "size", "used"]]

        return rows.withColumn("task", F.pmod(F.xxhash64("item", "part"), F.lit(tasks))).groupBy("task").applyInPandas(run, schema)

    first = cut(filled(loose, "t"))
    open_ = F.col("used") * 2 < capacity
    again = filled(first.where(open_).select("item", "part", "size"), "r")
    return done.unionByName(first.where(~open_).drop("used")).unionByName(again.drop("used"))


def pack_documents(df: DataFrame, doc: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Containers of ``capacity`` tokens for documents, measured with the tokenizer at ``vocabulary``."""
    return pack_items(df.select(F.col(doc).alias("doc"), token_count(F.col(text), vocabulary).alias("size")), "doc", "size", capacity)
