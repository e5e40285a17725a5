"""The operators over whole tables, as the queries op1 to op13, and their SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from pitwall.llm import bpe, hamming, jaccard, mixing, negatives, pii, ppm, resampling, suffix, syncmers, turns, url_lists, warc
from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise, scratch_dir


# Payloads below this size are always stored.
REVISIT_BYTES = 1000
NEAREST = 10
# One document in so many is sampled.
SAMPLE_OF = 10


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _number(column, digits=4):
    """A number from the start of a hash, the same in any engine."""
    return F.conv(F.substring(F.md5(column), 1, digits), 16, 10).cast("int")


def captures(spark, sf_dir):
    """Pages with a fetch day in a year, derived from the URL."""
    return _read(spark, sf_dir, "pages").select("page_id", "url", (_number(F.col("url")) % 365).alias("fetch_day"))


def list_entries(spark, sf_dir):
    """Dated entries of three lists, derived from the hosts, domains and first path steps of the pages."""
    pages = _read(spark, sf_dir, "pages")
    name, step = url_lists.host(F.col("url")), F.split_part(url_lists.path(F.col("url")), F.lit("/"), F.lit(2))
    hosts = pages.select(name.alias("pattern")).dropna().distinct().withColumn("c", _number(F.col("pattern")))
    prefixes = pages.select(F.concat(name, F.lit("/"), step, F.lit("/")).alias("pattern")).dropna().distinct()
    prefixes = prefixes.withColumn("c", _number(F.col("pattern")))
    domains = hosts.select(F.regexp_extract("pattern", r"([^.]+\.[^.]+)$", 1).alias("pattern")).filter("pattern <> ''").distinct()
    domains = domains.withColumn("c", _number(F.col("pattern")))
    parts = [
        (hosts.filter("c % 4 = 0"), "spam", "host", "c % 200", "add"),
        (hosts.filter("c % 4 = 0"), "spam", "host", "c % 200 + 20 + c % 90", "remove"),
        (hosts.filter("c % 8 = 0"), "spam", "host", "300 + c % 30", "add"),
        (prefixes.filter("c % 6 = 0"), "adult", "prefix", "c % 300", "add"),
        (domains, "review", "domain", "c % 250", "add"),
        (domains.filter("c % 2 = 0"), "review", "domain", "c % 250", "remove"),
    ]
    found = None
    for rows, list_, kind, day, action in parts:
        rows = rows.selectExpr(f"'{list_}' as list", f"'{kind}' as kind", "pattern", f"{day} as day", f"'{action}' as action")
        found = rows if found is None else found.unionByName(rows)
    return found


def op1_temporal_url_lists(spark, sf_dir):
    found = url_lists.active_lists(captures(spark, sf_dir), list_entries(spark, sf_dir))
    return found.select("row.*", F.array_join("lists", ",").alias("lists"), (F.size("lists") > 0).alias("filtered"))


def page_records(pages):
    """One archive record per page: the largest id of equal payloads is the response, the others revisit it."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    groups = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
    groups = groups.agg(F.max("page_id").alias("first"), F.count("*").alias("many")).filter("many > 1")
    groups = materialise(groups.select("payload_digest", "first"), "payloads")
    rows = rows.join(broadcast_if_small(groups), "payload_digest", "left")
    again = F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    named = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.select(
        named("page_id").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.when(again, named("first")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def op2_warc_archive(spark, sf_dir):
    """Digest and length come from the payloads that the archive gives back; a revisit has those of its response."""
    path = f"{scratch_dir(spark)}/pitwall/warc-{uuid.uuid4().hex}"
    warc.write_warc(page_records(_read(spark, sf_dir, "pages")), path)
    number = lambda c: F.substring_index(c, ":", -1).try_cast("long")
    read = warc.read_warc(spark, path).filter("record_type = 'response'")
    stored = read.select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    stored = materialise(stored, "responses")
    again = warc.read_warc(spark, path, payload=False).filter("record_type = 'revisit'").select("record_id", "refers_to")
    first = stored.select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest")
    again = again.join(first, "refers_to", "left").withColumn("record_type", F.lit("revisit"))
    found = stored.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("string")}).unionByName(again)
    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


def op3_closed_syncmers(spark, sf_dir):
    found = syncmers.edited(syncmers.fingerprints(_read(spark, sf_dir, "documents").select("doc_id", "text")))
    found = syncmers.with_anchors(found, "edited", "edited_anchors")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.shown("anchors").alias("fingerprint"),
        syncmers.shown("edited_anchors").alias("edited_fingerprint"),
        syncmers.likeness("anchors", "edited_anchors").alias("near_edited"),
        syncmers.likeness("anchors", "next_anchors").alias("near_next"),
    )


def op4_ngram_jaccard(spark, sf_dir):
    found = jaccard.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def held_out():
    """Whether the CRC-32 of the id as text is divisible by five."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def language_model(spark, sf_dir):
    return ppm.fit(_read(spark, sf_dir, "documents").filter(~held_out()).select("doc_id", "text", "lang"))


def op5_ppm_language(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = ppm.identify(docs, language_model(spark, sf_dir)).select("row.doc_id", "lang_pred", "score")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_importance_resampling(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    target = _read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    found = resampling.resample(docs, target, docs.count() // SAMPLE_OF)
    return found.select("row.doc_id", "log_weight", F.col("key").alias("gumbel_key"), "selected")


def op7_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op8_hamming_search(spark, sf_dir):
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    codes = materialise(hamming.sign_codes(vectors, "vec_id", "embedding", dims), "sign_codes")
    found = hamming.top_k(codes, codes.filter("id % 50 = 0"), NEAREST, dims)
    return found.withColumnRenamed("id", "vec_id")


def op9_source_mix(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found, sources = mixing.mix(docs)
    found = found.select("row.doc_id", "size", "taken", F.col("sources")[0].alias("_source"))
    same = found["_source"].eqNullSafe(sources["source"])
    return found.join(F.broadcast(sources), same).select("doc_id", "size", "source_size", "target", "taken")


def op10_suffix_dedup(spark, sf_dir):
    found = suffix.remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def damaged(spark, sf_dir):
    """Conversations of which some rows are dropped, emptied, cut, repeated or given another role."""
    rows = _read(spark, sf_dir, "conversations")
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"))
    rows = rows.withColumn("code", F.crc32(F.concat_ws(":", known("conv_id"), known("turn"))) % 20).filter("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark, sf_dir):
    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = turns.repair(damaged(spark, sf_dir)).filter("last").select(F.col("conv_id").alias("_conv"), *totals, "audit", "digest")
    every = _read(spark, sf_dir, "conversations").select("conv_id").distinct()
    found = every.join(found, every.conv_id.eqNullSafe(found["_conv"]), "left")
    return found.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in totals),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_personal_data(spark, sf_dir):
    found = pii.find(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id",
        *(pii.of_kind(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")),
        F.sha2(pii.shown(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.shown(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op13_hard_negatives(spark, sf_dir):
    rows = negatives.integer_vectors(_read(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved))


QUERIES = {f.__name__: f for f in (op1_temporal_url_lists, op2_warc_archive, op3_closed_syncmers, op4_ngram_jaccard, op5_ppm_language, op6_importance_resampling, op7_byte_bpe, op8_hamming_search, op9_source_mix, op10_suffix_dedup, op11_conversation_repair, op12_personal_data, op13_hard_negatives)}

ORACLE = {
    "op1_temporal_url_lists": r"""
        with p as (
            select page_id, url, ('0x' || md5(url)[1:4])::int % 365 as fetch_day,
                   nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') as host,
                   '/' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1) as path
            from pages
        ), h as (select distinct host as pattern, ('0x' || md5(host)[1:4])::int as c from p where host is not null
        ), x as (
            select distinct pattern, ('0x' || md5(pattern)[1:4])::int as c
            from (select host || '/' || split_part(path, '/', 2) || '/' as pattern from p) where pattern is not null
        ), d as (
            select distinct pattern, ('0x' || md5(pattern)[1:4])::int as c
            from (select regexp_extract(pattern, '([^.]+[.][^.]+)$', 1) as pattern from h) where pattern <> ''
        ), e as (
            select 'spam' as list, 'host' as kind, pattern, c % 200 as day, 'add' as action from h where c % 4 = 0
            union all select 'spam', 'host', pattern, c % 200 + 20 + c % 90, 'remove' from h where c % 4 = 0
            union all select 'spam', 'host', pattern, 300 + c % 30, 'add' from h where c % 8 = 0
            union all select 'adult', 'prefix', pattern, c % 300, 'add' from x where c % 6 = 0
            union all select 'review', 'domain', pattern, c % 250, 'add' from d
            union all select 'review', 'domain', pattern, c % 250, 'remove' from d where c % 2 = 0
        ), v as (
            select *, lead(day) over (partition by list, kind, pattern order by day) as until
            from (select list, kind, pattern, day, max(action) as action from e group by all)
        ), m as (
            select distinct page_id, url, list from p, v
            where action = 'add' and day <= fetch_day and (until is null or fetch_day < until) and (
                kind = 'host' and host = pattern
                or kind = 'domain' and (host = pattern or ends_with(host, '.' || pattern))
                or kind = 'prefix' and starts_with(host || rtrim(path, '/') || '/', pattern))
        )
        select page_id, url, fetch_day, coalesce(string_agg(list, ',' order by list), '') as lists, count(list) > 0 as filtered
        from p left join m using (page_id, url) group by page_id, url, fetch_day""",
    "op2_warc_archive": """
        with p as (
            select page_id, sha1(coalesce(html, '')) as payload_digest, strlen(coalesce(html, '')) as payload_bytes from pages
        ), f as (
            select payload_digest, max(page_id) as response from p where payload_bytes >= 1000 group by payload_digest
        )
        select page_id, payload_bytes, payload_digest,
               case when response is not null and response <> page_id then 'revisit' else 'response' end as record_type,
               case when response <> page_id then response end as refers_to
        from p left join f using (payload_digest)""",
    "op8_hamming_search": """
        with c as (
            select vec_id, list_transform(embedding, lambda x: if(x > 0, 1, 0)) as b from embeddings where embedding is not null
        ), d as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.b, c.b), lambda p: abs(p[1] - p[2])))::int as distance
            from c q, c where q.vec_id % 50 = 0
        )
        select query_id, row_number() over (partition by query_id order by distance, vec_id)::int as rank, vec_id, distance
        from d qualify rank <= 10""",
    "op13_hard_negatives": """
        with t as (
            select vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings
            where label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select a.vec_id as anchor_id, a.label = c.label as same, c.vec_id as id,
                   list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::bigint as score
            from t a, t c where a.vec_id % 50 = 0 and a.vec_id <> c.vec_id
        ), p as (
            select anchor_id, id as positive_id, score as positive_score from s where same
            qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
        )
        select anchor_id, positive_id,
               row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank,
               id as negative_id, positive_score, score as negative_score
        from p join s using (anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify rank <= 3""",
}


def _personal_data_sql() -> str:
    """The spans by splitting at matches, as in the operator, with list functions and running sums by slices."""
    digits, code = "regexp_replace(m, '[^0-9]', '', 'g')", "replace(m, ' ', '')"
    luhn = f"""list_sum(list_transform(range(1, length({digits}) + 1), lambda j:
        if((length({digits}) - j) % 2 = 1, [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][{digits}[j]::int + 1], {digits}[j]::int))) % 10 = 0"""
    mod_97 = f"""list_reduce(list_prepend(0, list_transform(string_split(concat({code}[5:], {code}[1:4]), ''), lambda c:
        if(c <= '9', ascii(c) - 48, ascii(c) - 55))), lambda a, x: (a * if(x > 9, 100, 10) + x) % 97) = 1"""
    # pattern and rule of each kind; the kinds stand in the order of the operator
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(m, '.'), lambda x: x::hugeint > 255)) = 0"),
        "card": ("[0-9](?:[ -]?[0-9])+", f"length({digits}) between 14 and 19 and {luhn}"),
        "phone": (r"\+[0-9][ ().0-9-]+[0-9]", f"length({digits}) between 10 and 15"),
        "iban": (
            r"\b[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b",
            f"length({code}) between 15 and 34 and {mod_97}",
        ),
        "ssn": (
            r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
            "m[1:3] not in ('000', '666') and m < '9' and m[5:6] <> '00' and m[8:] <> '0000'",
        ),
    }
    parts = []
    for no, kind in enumerate(pii.KINDS):
        pattern, rule = kinds[kind.name]
        near = "right(b[i], 40) || ' ' || left(b[i + 1], 40)"
        score = (
            f"{kind.points} + if(regexp_matches({near}, '{pii.any_word(kind.words)}'), 20, 0)"
            f" - if(regexp_matches({near}, '{pii.any_word(pii.AGAINST)}'), 20, 0)"
        )
        parts.append(f"""
            select doc_id, '{kind.name}' as kind, {no} as no, length(m) as size, {score} as score, {str(kind.base).lower()} as base,
                   list_sum(list_transform(b[1:i], lambda x: length(x))) + list_sum(list_transform(f[1:i], lambda x: length(x))) as stop
            from (
                select doc_id, b, f, i, f[i] as m from (
                    select doc_id, b, f, unnest(range(1, len(f) + 1)) as i from (
                        select doc_id, regexp_split_to_array(t, '{pattern}') as b, regexp_extract_all(t, '{pattern}') as f from d)))
            where {rule}{"" if kind.base else f" and {score} >= 60"}""")
    return f"""
        with d as (select doc_id, coalesce(text, '') as t from documents),
        s as ({" union all ".join(parts)}),
        g as (
            select doc_id, kind, no, score, base, concat(kind, ':', stop - size, ':', stop) as shown, stop - size as start from s
        )
        select doc_id,
               {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in ("email", "ip", "card", "phone"))},
               sha256(coalesce(string_agg(shown, ',' order by start, no) filter (base), '')) as base_sha256,
               coalesce(string_agg(shown, ',' order by start, no), '') as spans,
               coalesce(string_agg(score::varchar, ',' order by start, no), '') as scores
        from d left join g using (doc_id) group by doc_id"""


ORACLE["op12_personal_data"] = _personal_data_sql()
