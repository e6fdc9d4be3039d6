"""Records that differ only in layout, letter case, punctuation or order of their labelled fields.

Each text gets a canonical key. Keys of more than `hot_rows` records are known exactly from partial counts; these
hot keys are aggregated in two levels (key and salt, then key), all others in one. A group's
representative is its smallest identifier.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslathe.runtime import count_up_to, materialize

HOT_ROWS = 50_000
SALTS = 32
#: A group's pairs are made in blocks of about this many members on one side.
BLOCK = 2_000
BROADCAST_GROUPS = 50_000

_NOT_ALNUM = re.compile(r"[\W_]+")
_PARTS = re.compile(r"\s*[\r\n\x0b\x0c\x85\u2028\u2029]+\s*|\s+\|\s+")
#: A label is one phrase, however long: no sentence ends within it.
_LABEL = re.compile(r"[\W_]*+([^\W_](?:[^:：.!?。！？]|[.!?](?!\s))*+)[:：](?!(?<=\d.)\d)")
_LETTER = re.compile(r"[^\W\d_]")


def squeeze(s: str) -> str:
    """Letters and digits alone, without case."""
    return _NOT_ALNUM.sub("", unicodedata.normalize("NFC", s).casefold())


def fields(text: str) -> list[tuple[str, str]] | None:
    """The labelled fields of a JSON object or of `Label: value` parts (by line or ` | `); None for prose.

    A part without a label carries on the value before it. Fewer than two labels, or a first part without one: prose.
    """
    a, b = text.find("{"), text.rfind("}")
    if 0 <= a < b and not squeeze(text[:a]) and not squeeze(text[b + 1 :]):
        try:
            pairs = json.loads(text[a : b + 1], strict=False, object_pairs_hook=_Pairs)
            if isinstance(pairs, _Pairs):
                return [(str(k), _flat(v)) for k, v in pairs]
        except (ValueError, RecursionError):
            pass
    out: list[list[str]] = []
    for part in _PARTS.split(text):
        m = _LABEL.match(part)
        if m and _LETTER.search(m[1]):
            out.append([m[1], part[m.end() :]])
        elif out:
            out[-1][1] += f" {part}"
        elif squeeze(part):
            return None
    return [(k, v) for k, v in out] if len(out) > 1 else None


class _Pairs(list):
    """Members of a JSON object, in their order, with repeated names."""


def _flat(v: object) -> str:
    if isinstance(v, _Pairs):
        return " ".join(sorted(f"{squeeze(str(k))} {_flat(x)}" for k, x in v))
    if isinstance(v, list):
        return " ".join(map(_flat, v))
    return v if isinstance(v, str) else json.dumps(v)


def canonical_key(text: str | None) -> str | None:
    """Hash of the content that layout can't change; None where there are no letters or digits."""
    if not text:
        return None
    got = fields(text)
    if got is not None:
        body = "\x1e".join(sorted(f"{squeeze(k)}\x1f{squeeze(v)}" for k, v in got))
        return hashlib.blake2b(b"F" + body.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    body = squeeze(text)
    return hashlib.blake2b(b"P" + body.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest() if body else None


def format_groups(rows: DataFrame, id_col: str, text_col: str, hot_rows: int = HOT_ROWS, salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """(groups, members): groups (content_key, representative, copies), members (id, content_key, representative, copies).

    One group per distinct content, groups of one included; copies counts rows, so rows repeated with the same id count too,
    while members lists each id once. A null, empty or letterless text has no content and no group. A null id is a row of its
    group but never a representative and no member. Equal ids are one member. Empty table: nothing.
    """

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "content_key": [canonical_key(t) for t in b["text"]]})

    id_type = rows.schema[id_col].dataType.simpleString()
    keys = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(keyed, f"id {id_type}, content_key string")
    keys = materialize(keys.where("content_key is not null"), "content_keys")
    # at most rows / hot_rows keys can be hot
    hot = materialize(keys.groupBy("content_key").count().where(F.col("count") > hot_rows).select("content_key"), "hot_keys")
    n_hot = hot.count()
    rest, groups = keys, None
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= 10_000 else hot
        rest = keys.join(hot, "content_key", "left_anti")
        salted = keys.join(hot, "content_key").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
        first = salted.groupBy("content_key", "salt").agg(F.min("id").alias("m"), F.count("*").alias("n"))
        groups = first.groupBy("content_key").agg(F.min("m").alias("representative"), F.sum("n").alias("copies"))
    one = rest.groupBy("content_key").agg(F.min("id").alias("representative"), F.count("*").alias("copies"))
    groups = materialize(one if groups is None else one.unionByName(groups), "groups")
    several = groups.where("copies > 1")
    if n_hot:  # rows of hot keys meet their few groups by broadcast, all others by shuffle
        big = several.join(hot, "content_key")
        m = keys.join(F.broadcast(big) if n_hot <= 10_000 else big, "content_key").unionByName(rest.join(several, "content_key"))
    else:
        m = keys.join(several, "content_key")
    single = groups.where("copies = 1 and representative is not null").select(F.col("representative").alias("id"), "content_key", "representative", "copies")
    members = m.where("id is not null").select("id", "content_key", "representative", "copies").distinct().unionByName(single)
    return groups, members


def pairs_within(members: DataFrame, group_col: str, id_col: str, block: int = BLOCK) -> DataFrame:
    """All pairs (a, b) of distinct ids of one group, a < b; a large group's pairs are spread over tasks by blocks of its members.

    Which groups are large is known from partial counts; those few meet their members by broadcast, so no task ever holds such a group.
    """
    m = materialize(members.select(F.col(group_col).alias("g"), F.col(id_col).alias("id")).distinct(), "group_members")
    large = m.groupBy("g").count().where(F.col("count") > block).select("g", F.ceil(F.col("count") / block).cast("int").alias("blocks"))  # at most rows / block
    large = materialize(large, "large_groups")
    m = m.join(F.broadcast(large) if count_up_to(large, BROADCAST_GROUPS) <= BROADCAST_GROUPS else large, "g", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    left = m.select("g", F.col("id").alias("a"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("blk"))
    right = m.select("g", F.col("id").alias("b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("blk"))
    return left.join(right, ["g", "blk"]).where("a < b").select("a", "b")
