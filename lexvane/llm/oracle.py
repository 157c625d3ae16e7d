"""SQL for the training-data queries that SQL can express."""

from __future__ import annotations

import string

from lexvane.llm.url_filter import HYPHENATED, RULES

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def folded(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def terms(table: str, key: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"select {key}, regexp_extract_all({folded('coalesce(text, chr(32))')}, '{pattern}') as t from {table}"


SEARCH = f"""with d as ({terms('documents', 'doc_id')}),
  s as (select count(*) filter (len(t) > 0) as docs, cast(sum(len(t)) as bigint) as total from d),
  tf as (select doc_id, term, n, count(*) as tf from (select doc_id, len(t) as n, unnest(t) as term from d) group by all),
  w as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w from tf, s group by term, docs),
  q as (select item_id, term, count(*) as k from (select item_id, unnest(t) as term from ({terms('benchmark', 'item_id')})) group by all),
  scored as (
    select item_id, doc_id, cast(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) as bigint) as score
    from q join w using (term) join tf using (term), s group by item_id, doc_id)
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
  from scored where score > 0 qualify rank <= 20"""


def _sized(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_sized, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _grown(name: str, leaves: str) -> str:
    """All levels of trees over rows ``(tree, idx, h)``."""
    return f"""{name}(tree, level, idx, h, n) as (
      select tree, 0, idx, h, count(*) over (partition by tree) from {leaves}
      union all
      select tree, level + 1, idx // 16, sha256(string_agg(h, '' order by idx)), (max(n) + 15) // 16
      from {name} where n > 1 group by tree, level, idx // 16)"""


def _folded(name: str, start: str, grown: str) -> str:
    """The node that each row ``(doc_id, tree, idx, h)`` leads to, level by level."""
    return f"""{name}(doc_id, tree, level, idx, h) as (
      select doc_id, tree, 0, idx, h from {start}
      union all
      select f.doc_id, f.tree, f.level + 1, f.idx // 16, sha256(string_agg(case when g.idx = f.idx then f.h else g.h end, '' order by g.idx))
      from {name} f join {grown} g on g.tree = f.tree and g.level = f.level and g.idx // 16 = f.idx // 16 and g.n > 1
      group by f.doc_id, f.tree, f.level, f.idx)"""


# The remainder of each byte by the polynomial of CRC-32, and the checksum of the decimal id.
_CRC = """remainders as (
    select list(list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) order by b) as r
    from (select unnest(range(256)) as b)),
  crcs as (
    select doc_id, xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
      lambda c, b: xor(c >> 8, r[cast(xor(c & 255, b) as integer) + 1]), 4294967295), 4294967295) as crc
    from documents, remainders)"""

MERKLE = f"""with recursive {_CRC},
  hashed as (
    select documents.doc_id, coalesce('s' || source, '') as tree, {_leaf('text')} as h,
      case when crc % 5 = 0 then {_leaf(folded('text'))} else {_leaf('text')} end as claim
    from documents join crcs using (doc_id)),
  leaves as (select *, row_number() over (partition by tree order by doc_id) - 1 as idx from hashed),
  {_grown('own', 'leaves')},
  subroots as (select tree as source, '' as tree, row_number() over (order by tree) - 1 as idx, h, level as height from own where n = 1),
  {_grown('top', 'subroots')},
  roots as (select h as root from top where n = 1),
  siblings as (
    select l.doc_id, 0 as part, g.level, g.idx, g.h from leaves l join own g
      on g.tree = l.tree and g.n > 1 and g.idx // 16 = l.idx // cast(16 ** (g.level + 1) as bigint) and g.idx <> l.idx // cast(16 ** g.level as bigint)
    union all
    select l.doc_id, 1, g.level, g.idx, g.h from leaves l join subroots s on s.source = l.tree join top g
      on g.n > 1 and g.idx // 16 = s.idx // cast(16 ** (g.level + 1) as bigint) and g.idx <> s.idx // cast(16 ** g.level as bigint)),
  proofs as (select doc_id, string_agg(h, '' order by part, level, idx) as proof from siblings group by doc_id),
  {_folded('climbed', '(select doc_id, tree, idx, claim as h from leaves)', 'own')},
  {_folded('ended', "(select c.doc_id, '' as tree, s.idx, c.h from climbed c join subroots s on c.tree = s.source and c.level = s.height)", 'top')},
  ends as (select doc_id, arg_max(h, level) as folded_root from ended group by doc_id)
  select doc_id, l.h as leaf, s.h as subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = root as verified
  from leaves l join subroots s on s.source = l.tree join ends using (doc_id) left join proofs using (doc_id), roots"""


def _by_rule(answers: dict[str, str]) -> str:
    """The answer of the longest rule that fits, else null."""
    cases = []
    for rule in sorted(answers, key=len, reverse=True):
        name, slash, rest = rule.partition("/")
        cases.append(f"when (host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '{slash}{rest}') then '{answers[rule]}'")
    return "case " + " ".join(cases) + " end"


URLS = f"""with split as (
    select page_id, {folded("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} as host,
      coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages)
  select page_id, host, path, {_by_rule({r: r for r, _ in RULES})} as rule,
    coalesce({_by_rule(dict(RULES))}, case when regexp_matches(host, '{HYPHENATED}') then 'block' else 'allow' end) as verdict
  from split"""


def oracle_sql() -> dict[str, str]:
    return {"op7_urls": URLS, "op12_search": SEARCH, "op13_merkle": MERKLE}
