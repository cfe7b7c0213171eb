"""SQL for those queries of this package that it can express."""

from __future__ import annotations


def _crc_table() -> str:
    """The table of CRC-32, from its polynomial."""

    def entry(n: int) -> int:
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        return n

    return "[" + ", ".join(f"{entry(n)}" for n in range(256)) + "]::bigint[]"


# CRC-32 is no function of this SQL, so it is folded over the bytes, two hexadecimal digits each.
_BYTES = "list_transform(range(octet_length(b)), lambda i: concat('0x', substr(h, 2 * i + 1, 2))::bigint)"
_CRC = f"xor(list_reduce(list_concat([4294967295::bigint], {_BYTES}), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295::bigint)"

# Pages have one template, so their articles can be cut out by pattern.
_ARTICLE = r"regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g')"
_DECODED = f"replace(replace(replace(replace(replace({_ARTICLE}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', ''''), '&amp;', '&')"

ORACLE_SQL: dict[str, str] = {
    "op3_html": rf"select page_id, url, t as text, length(t)::bigint as n_chars from (select page_id, url, regexp_replace(regexp_replace({_DECODED}, '\s+', ' ', 'g'), '^ | $', '', 'g') as t from pages)",
    "op10_sharding": f"""with r as (select doc_id, encode(coalesce(text, '')) as b, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint + 16 as size, {_crc_table()} as crc from documents),
      c as (select doc_id, size, {_CRC} as text_crc32 from r),
      p as (select *, 2 * (sum(size) over (order by doc_id nulls first, size, text_crc32 rows unbounded preceding) - size) + size as middle, sum(size) over () as everything from c),
      s as (select *, least(39, (middle * 40) // (2 * everything))::int as shard from p)
      select doc_id, size, text_crc32, 'bytes' as law, shard, (row_number() over (partition by shard order by middle) - 1)::bigint as slot, null::int as grown_shard from s""",
    # Every string of 200 bytes by its start; texts as hexadecimal digits, so that bytes can be cut and joined.
    "op9_repeats": """with d as (select doc_id, row_number() over () as k, encode(coalesce(text, '')) as b, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
      s as (select k, unnest(range(0, n - 199)) as o, b from d where n >= 200),
      g as (select k, o, count(*) over (partition by b[o + 1 : o + 200]) as n from s),
      m as (select k, o, case when o - lag(o) over (partition by k order by o) <= 200 then 0 else 1 end as fresh from g where n > 1),
      i as (select k, min(o) as x, max(o) + 200 as y from (select *, sum(fresh) over (partition by k order by o) as run from m) group by k, run),
      e as (select k, x, y, lag(y, 1, 0::bigint) over (partition by k order by x) as before from i),
      f as (select e.k, count(*) as spans, sum(y - x)::bigint as removed, max(y) as last, string_agg(substr(d.h, 2 * before + 1, 2 * (x - before)), '' order by x) as kept from e join d using (k) group by e.k)
      select d.doc_id, d.n as n_bytes, coalesce(f.removed, 0)::bigint as n_removed, coalesce(f.spans, 0)::bigint as n_spans, sha256(unhex(case when f.k is null then d.h else concat(f.kept, substr(d.h, 2 * f.last + 1)) end)) as kept_sha256
      from d left join f using (k)""",
}
