"""Personal data, and the terms that would give it away after it is taken out.

Patterns find e-mail and IP addresses, card and phone numbers: the protected entities.  Terms near them are judged by
what the corpus tells about the pair.  With probabilities as shares of distinct texts, a term ``t`` gives
``log2(p(c|t) / p(c))`` bits about an entity ``c``, and leaves ``-log2 p(c|t)`` bits unknown.  A term discloses ``c`` when it
gives at least ``min_bits``, leaves at most ``max_left`` and stands near ``c`` in at least ``min_texts`` texts.  All its occurrences in
documents that hold ``c`` are then generalised to the term's beginning, if that beginning stands near other entities
often enough to say little, or else removed.  Documents without the entity keep the term: with its own documents
sanitised nothing ties it to ``c`` any more.

Copies of a text are one observation.  Counts cover all documents: pairs of entities and near terms are aggregated by
Spark; how many texts hold a candidate term is counted in a second pass, in which a bit table of fixed size, made from the
candidates, leaves out most words before the exact join.

Terms are words between blanks, lower-cased, without what is no letter or digit at either end, with a letter and
``MIN_TERM`` characters at least; near are the ``NEAR`` words before and behind an entity.  Words that touch an entity are no terms.

Defined cases: null and empty texts hold nothing; rows that repeat are each reported; a null id is kept; spans of
different kinds may overlap; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.sized import keep, lookup_join
from flowloom.llm.arrow_words import slices, split_words, whole_texts

KINDS = ("email", "ip", "card", "phone", "term")
#: Words on either side of an entity that count as near; characters of a term and of its generalised form.
NEAR, MIN_TERM, BEGINNING = 10, 3, 4
#: Bits of the table that preselects candidate terms; a power of two, 1 MB.
FILTER_BITS = 1 << 23
#: Words whose test a task remembers.
KNOWN_WORDS = 100_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^ \t-\r]+")
_CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)
_SPAN = "struct<start:bigint,kind:int,end:bigint,entity:string>"
_FOUND = f"doc_id bigint, text_hash string, base array<{_SPAN}>, near array<struct<entity:string,term:string>>, text string"
_SPANS = "row bigint, spans array<struct<start:bigint,kind:int,end:bigint>>, n_generalised bigint, n_removed bigint, sanitised string"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int, str]]:
    """One match per @ at most: what stands before it up to the last match, and a domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done, text[start:done].lower()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int, str]]:
    """Numbers joined by dots, four at a time."""
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            numbers = [p.lstrip("0") or "0" for p in four]
            if all(len(p) <= 3 and int(p) <= 255 for p in numbers):
                yield at, end, ".".join(numbers)
            at = end + 1


def entities(text: str, kinds: tuple[bool, bool, bool, bool] = (True,) * 4) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of all matches of the asked kinds, sorted; values in one spelling."""
    out = [(a, 1, b, v) for a, b, v in _emails(text)] if kinds[0] else []
    if kinds[1]:
        out += [(a, 2, b, v) for a, b, v in _ips(text)]
    if kinds[2]:
        for m in _DIGITS.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 3, m.end(), digits))
    if kinds[3]:
        for m in _PHONE.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 10 <= len(digits) <= 15:
                out.append((m.start(), 4, m.end(), digits))
    return sorted(out)


def term_of(word: str) -> tuple[str, int, int] | None:
    """The term in a word and its place there."""
    core = _CORE.search(word)
    if core is None or len(core[0]) < MIN_TERM or not any(c.isalpha() for c in core[0]):
        return None
    return core[0].lower(), *core.span()


def beginning(term: str) -> str | None:
    """The generalised form of a term; no term has its mark."""
    return term[:BEGINNING] + "*" if len(term) > BEGINNING else None


def terms_outside(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int, str | None]]:
    """Start, end and term of every word; None where it holds none or touches one of the sorted spans."""
    out, k = [], 0
    for m in _WORD.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        found = term_of(m[0]) if k == len(spans) or spans[k][0] >= m.end() else None
        a, b = found[1:] if found else (0, len(m[0]))
        out.append((m.start() + a, m.start() + b, found[0] if found else None))
    return out


def _covered(base: list[tuple[int, int, int, str]]) -> list[tuple[int, int]]:
    """The places of the spans, joined where they overlap."""
    out: list[tuple[int, int]] = []
    for start, _, end, _ in base:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _near(text: str, base: list[tuple[int, int, int, str]]) -> set[tuple[str, str]]:
    """Entities with the terms, and the beginnings of terms, near them."""
    words = terms_outside(text, _covered(base))
    starts = [m.start() for m in _WORD.finditer(text)]
    out = set()
    for start, _, end, entity in base:
        first, last = np.searchsorted(starts, [start, end], side="left")
        inside = max(0, int(first) - 1) if first == len(starts) or starts[first] > start else int(first)
        for _, _, term in (*words[max(0, inside - NEAR) : inside], *words[int(last) : int(last) + NEAR]):
            if term is not None:
                out.add((entity, term))
                if wide := beginning(term):
                    out.add((entity, wide))
    return out


def _scan(keep_texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = whole_texts(part.column("text"))
                # Linear-time tests leave the whole work to few texts.
                likely = [
                    pc.match_substring(texts, "@"), pc.match_substring_regex(texts, r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
                    pc.match_substring_regex(texts, r"[0-9]([ -]?[0-9]){13}"), pc.match_substring_regex(texts, r"\+[0-9][ ().0-9-]+[0-9]"),
                ]
                flags = np.array([x.to_numpy(zero_copy_only=False) for x in likely]).T
                hashes, base, near, shown = [], [], [], []
                for text, kinds in zip(texts, flags, strict=True):
                    hashes.append(hashlib.blake2b(text.as_buffer(), digest_size=16).hexdigest() if len(text.as_buffer()) else "")
                    value = text.as_py() if keep_texts or kinds.any() else None
                    found = entities(value, tuple(kinds)) if kinds.any() else []
                    # Entities go on as digests.
                    found = [(a, k, b, hashlib.blake2b(f"{k}:{v}".encode(), digest_size=12).hexdigest()) for a, k, b, v in found]
                    base.append([dict(zip(("start", "kind", "end", "entity"), f, strict=True)) for f in found])
                    near.append([{"entity": e, "term": t} for e, t in sorted(_near(value, found))] if found else [])
                    shown.append(value if keep_texts or found else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(hashes, pa.string()),
                        pa.array(base, pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("entity", pa.string())]))),
                        pa.array(near, pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))), pa.array(shown, pa.string()),
                    ],
                    names=["doc_id", "text_hash", "base", "near", "text"],
                )

    return run


def scan(documents: DataFrame, keep_texts: bool = False) -> DataFrame:
    """Per document its entities, the terms near them, and, where it has entities or all are asked for, its text."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan(keep_texts), _FOUND).withColumn("row", F.monotonically_increasing_id())


def _bit_table(terms: DataFrame) -> np.ndarray:
    """Bits of the hashes of all terms, 64 to a number; at most ``FILTER_BITS / 64`` rows come to the driver."""
    place = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    rows = terms.select(F.call_function("div", place, F.lit(64).cast("long")).alias("at"), one.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    table[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return table


def _holders(table: np.ndarray):
    """Distinct terms of every text that are in the bit table, with the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known: dict[str, str | None] = {}
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                texts = whole_texts(part.column("text"))
                words, offsets = split_words(texts)
                coded = words.dictionary_encode()
                if len(known) > KNOWN_WORDS:
                    known.clear()
                wanted = np.zeros(len(coded.dictionary), dtype=np.int64)
                names: dict[str, int] = {}
                for k, word in enumerate(coded.dictionary.to_pylist()):
                    if word in known:
                        term = known[word]
                    else:
                        found = term_of(word)
                        term = found[0] if found else None
                        if term is not None:
                            place = xxhash.xxh64_intdigest(term.encode(), seed=42) % FILTER_BITS
                            term = term if int(table[place >> 6]) >> (place & 63) & 1 else None
                        known[word] = term
                    if term is not None:
                        wanted[k] = names.setdefault(term, len(names) + 1)
                term_ids = wanted[coded.indices.to_numpy()] if len(words) else np.zeros(0, dtype=np.int64)
                at = np.flatnonzero(term_ids)
                doc = np.searchsorted(offsets, at, side="right") - 1
                pairs = np.unique(doc * (len(names) + 1) + term_ids[at])
                listed = pa.array(["", *names], pa.string())
                hashes = [hashlib.blake2b(texts[int(d)].as_buffer(), digest_size=16).hexdigest() for d in np.unique(doc)]
                which = np.searchsorted(np.unique(doc), pairs // (len(names) + 1))
                yield pa.RecordBatch.from_arrays(
                    [listed.take(pa.array(pairs % (len(names) + 1))), pa.array(hashes, pa.string()).take(pa.array(which))], names=["term", "text_hash"]
                )

    return run


def disclosing_terms(documents: DataFrame, found: DataFrame, min_texts: int, max_left: float, min_bits: float) -> DataFrame:
    """``entity, term, general``: terms that disclose an entity, and their generalised form if that says little."""
    n_texts = F.broadcast(found.agg(F.count_distinct("text_hash").alias("n_texts")))
    with_base = found.filter(F.size("base") > 0)
    held = with_base.select("text_hash", F.explode(F.array_distinct(F.transform("base", lambda s: s["entity"]))).alias("entity")).distinct()
    n_entity = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    near = with_base.select("text_hash", F.explode("near").alias("p")).select("text_hash", "p.entity", "p.term").distinct()
    pairs = keep(near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")))
    beside = keep(near.select("text_hash", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_beside")))
    # A term near other entities in more texts than the limit allows cannot disclose this one.
    share = 2.0**-max_left
    wide = F.endswith("term", F.lit("*"))
    often = pairs.filter((F.col("n_both") >= min_texts) & ~wide).join(beside, "term").filter(F.col("n_both") >= share * F.col("n_beside"))
    candidates = keep(often.join(n_entity, "entity"))
    table = _bit_table(candidates.select("term"))
    holding = documents.select("text").mapInArrow(_holders(table), "term string, text_hash string")
    n_term = holding.join(candidates.select("term").distinct(), "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    p = F.col("n_both") / F.col("n_term")
    bits = F.log2(p * F.col("n_texts") / F.col("n_entity"))
    judged = candidates.join(n_term, "term").crossJoin(n_texts).filter((p >= share) & (bits >= min_bits))
    # What is known of a beginning from texts with entities alone bounds what it discloses.
    general = pairs.filter(wide).join(beside, "term").filter(F.col("n_both") < share / 2 * F.col("n_beside")).select("entity", F.col("term").alias("general"))
    start = F.when(F.length("term") > BEGINNING, F.concat(F.substring("term", 1, BEGINNING), F.lit("*")))
    return judged.select("entity", "term", start.alias("general")).join(general.withColumn("_known", F.lit(True)), ["entity", "general"], "left").select(
        "entity", "term", F.when(F.col("_known"), F.col("general")).alias("general")
    )


def _apply(with_texts: bool):
    """Spans of entities and disclosing terms; the text with either replaced."""

    def one(text: str, base: list[tuple[int, int, int, str]], general: dict[str, str | None]):
        spans = [(a, k, b, f"[{KINDS[k - 1]}]") for a, k, b, _ in base]
        for a, b, term in terms_outside(text, _covered(base)) if general else []:
            if term in general:
                spans.append((a, 5, b, general[term] or ""))
        spans.sort(key=lambda s: s[:3])
        pieces, at = [], 0
        for a, _, b, new in spans if with_texts else []:
            if b > at:
                # A span that overlaps the one before goes with it.
                pieces += [text[at:a], new] if a >= at else []
                at = b
        terms = [s for s in spans if s[1] == 5]
        return spans, sum(bool(s[3]) for s in terms), sum(not s[3] for s in terms), "".join(pieces) + text[at:] if with_texts else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Python objects of a few rows at a time: texts and lists of terms may be long.
        for part in (batch.slice(at, 32) for batch in batches for at in range(0, batch.num_rows, 32)):
            rows = []
            for r in part.to_pylist():
                base = [(s["start"], s["kind"], s["end"], s["entity"]) for s in r["base"]]
                general: dict[str, str | None] = {}
                for t in r["terms"] or []:
                    # Of two entities that a term discloses, the stricter one counts.
                    general[t["term"]] = t["general"] if general.get(t["term"], t["general"]) else None
                rows.append((r["row"], *one(r["text"], base, general)))
            listed = [[{"start": a, "kind": k, "end": b} for a, k, b, _ in x[1]] for x in rows]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.int64()), pa.array(listed, kind), pa.array([x[2] for x in rows], pa.int64()), pa.array([x[3] for x in rows], pa.int64()), pa.array([x[4] for x in rows], pa.string())],
                names=["row", "spans", "n_generalised", "n_removed", "sanitised"],
            )

    return run


def find_disclosures(documents: DataFrame, texts: bool = False, min_texts: int = 3, max_left: float = 0.152, min_bits: float = 3.0) -> DataFrame:
    """One row per document: ``base`` and ``spans`` (start, kind, end), ``n_generalised, n_removed``, with ``texts`` the sanitised text.

    ``max_left`` of 0.152 bits is a share of 0.9 of the texts that hold the term.
    """
    found = keep(scan(documents, texts))
    disclosed = keep(disclosing_terms(documents, found, min_texts, max_left, min_bits))
    grouped = disclosed.groupBy("entity").agg(F.collect_list(F.struct("term", "general")).alias("terms"))
    holders = found.filter(F.size("base") > 0)
    own = holders.select("row", F.explode(F.array_distinct(F.transform("base", lambda s: s["entity"]))).alias("entity"))
    terms = lookup_join(own, grouped, ["entity"], spread=["row"], how="inner").groupBy("row").agg(F.flatten(F.collect_list("terms")).alias("terms"))
    whole = holders if texts else holders.join(terms.select("row"), "row", "left_semi")
    some = whole.select("row", "base", "text").join(terms, "row", "left").select("row", "base", "text", "terms")
    applied = some.mapInArrow(_apply(texts), _SPANS)
    zero = F.lit(0).cast("long")
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    base = found.select("row", "doc_id", plain.alias("base"), *(["text"] if texts else []))
    joined = base.join(applied, "row", "left").withColumns({"spans": F.coalesce("spans", "base"), "n_generalised": F.coalesce("n_generalised", zero), "n_removed": F.coalesce("n_removed", zero)})
    names = ["doc_id", "base", "spans", "n_generalised", "n_removed"]
    return joined.select(*names, F.coalesce("sanitised", "text").alias("text")) if texts else joined.select(*names)


def listed(spans: str) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def report(documents: DataFrame, **options) -> DataFrame:
    """Counts per kind, digest of the base spans, all spans as text, and how many terms were generalised or removed."""
    found = find_disclosures(documents, **options)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:4], 1)]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"), "n_generalised", "n_removed")
