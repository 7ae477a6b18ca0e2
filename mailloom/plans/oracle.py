"""SQL with the same results as the registered queries, for an independent check.

Threads are split here with windows over lines, not with the regular
expressions used in `functions.threads`.
"""

from __future__ import annotations

from mailloom.functions.text import BLANK_CODES, LINE_BREAK_CODES

_SPACE = "[" + "".join(f"\\x{{{c:x}}}" for c in (*BLANK_CODES, *LINE_BREAK_CODES)) + "]"
_NL = "chr(10)"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SPACE}+', ' ', 'g'))"


def _strip_junk(x: str) -> str:
    line = r"[ \t]*(_{5,}[ \t]*)?"
    front = f"regexp_replace({x}, '^({line}\\n)*({line}$)?', '')"
    return _trim(f"regexp_replace({front}, '(\\n{line})+$', '')")


def _subject(x: str) -> str:
    marker = r"\s*(re|fw|fwd|aw|wg|sv|vs)\s*(\[[0-9]+\])?\s*:\s*"
    return f"lower({_collapse(f'''regexp_replace({x}, '^({marker})+', '', 'i')''')})"


def _thread(x: str) -> str:
    return f"sha256(coalesce(nullif({_subject(x)}, ''), 'no-subject'))[1:8]"


def _slug(x: str, n: int = 60) -> str:
    dashed = f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"
    return f"coalesce(nullif(trim(left({dashed}, {n}), '-'), ''), 'untitled')"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


_LONG = "'%A, %B %-d, %Y %-I:%M %p'"

MAILBOX = f"""
told AS (
  SELECT conv_id, turn, text,
    TIMESTAMP '2026-07-01 00:00:00' + to_hours(conv_id) + to_minutes(turn) AS sent,
    concat(CASE turn % 3 WHEN 1 THEN 'Re: ' WHEN 2 THEN 'FW: Re: ' ELSE '' END, 'Topic ', conv_id % 40) AS subject,
    concat(role, conv_id, ' <', role, conv_id, '@example.com>') AS from_
  FROM conversations),
blocks AS (
  SELECT *, concat({_NL}, '________________________________', {_NL}, 'From: ', from_, {_NL},
    'Sent: ', strftime(sent, {_LONG}), {_NL},
    'To: Team <team@example.com>;', {_NL}, ' Archive <archive@example.com>', {_NL}, 'Subject: ', subject, {_NL}, {_NL},
    CASE WHEN conv_id % 7 = 0 THEN concat('CAUTION: EXTERNAL EMAIL', {_NL}, {_NL}) ELSE '' END, text) AS block
  FROM told),
quoted AS (
  SELECT a.conv_id, a.turn, string_agg(b.block, '' ORDER BY b.turn DESC) AS q
  FROM blocks a JOIN blocks b ON a.conv_id = b.conv_id AND b.turn < a.turn AND b.turn >= a.turn - 3
  GROUP BY 1, 2),
mailbox AS (
  SELECT t.conv_id, t.turn,
    concat('emails/', CASE WHEN t.conv_id % 11 = 0 THEN 'misc' ELSE strftime(sent, '%Y-%m-%d') END,
      CASE WHEN pure THEN '/FWD' ELSE '/MSG' END, t.conv_id, '-', t.turn, '==.eml') AS source_key,
    sent AS modification_time,
    CASE WHEN t.turn % 4 <> 3 THEN concat(CASE WHEN pure THEN '<f' ELSE '<m' END, t.conv_id, '.', t.turn, '@example.com>') END AS message_id,
    from_, 'Team <team@example.com>' AS to_,
    CASE WHEN t.conv_id % 6 = 0 THEN 'Lead <lead@example.com>' END AS cc, subject,
    CASE WHEN t.turn <> 5 THEN concat(strftime(sent, '%a, %d %b %Y %H:%M:%S'),
      CASE WHEN t.turn % 4 = 1 THEN ' -0700' ELSE ' +0000' END) END AS date_header,
    concat(CASE WHEN pure THEN '' ELSE text END, coalesce(q, '')) AS body
  FROM (SELECT *, unnest(CASE WHEN conv_id % 5 = 0 AND turn > 0 THEN [false, true] ELSE [false] END) AS pure FROM told) t
  LEFT JOIN quoted USING (conv_id, turn))
"""

LINES = r"""
line_lists AS (
  SELECT source_key, CASE WHEN body = '' THEN [] ELSE string_split(regexp_replace(body, '\n$', ''), chr(10)) END AS l
  FROM (SELECT source_key, regexp_replace(body, '\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g') AS body
        FROM mailbox)),
lines AS (
  SELECT source_key, CAST(i - 1 AS BIGINT) AS line_no, l[i] AS line
  FROM (SELECT source_key, l, unnest(range(1, len(l) + 1)) AS i FROM line_lists))
"""

SEGMENTS = r"""
flags AS (
  SELECT *, regexp_matches(line, '^\s*From\s*:\s?.+$', 'i') AS is_from,
    regexp_matches(line, '^\s*(Sent|Date)\s*:\s?.+$', 'i') AS is_sent
  FROM lines),
bounds AS (
  SELECT *, is_from AND coalesce(bool_or(is_sent) OVER (PARTITION BY source_key ORDER BY line_no
    ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), false) AS opens
  FROM flags),
segs AS (
  SELECT source_key, line_no, line, CAST(sum(CAST(opens AS INT)) OVER (PARTITION BY source_key ORDER BY line_no) AS BIGINT) AS seg
  FROM bounds)
"""

UNITS = (
    r"""
blanks AS (
  SELECT source_key, seg, min(line_no) FILTER (trim(line) = '') AS blank FROM segs WHERE seg > 0 GROUP BY 1, 2),
head_lines AS (
  SELECT s.*, lower(regexp_extract(line, '^\s*(From|Sent|Date|To|Cc|Subject|Importance)\s*:\s?(.*)$', 1, 'i')) AS key
  FROM segs s JOIN blanks b USING (source_key, seg)
  WHERE (b.blank IS NULL OR line_no < b.blank) AND NOT regexp_matches(line, '^\s*_{5,}\s*$')),
occurrences AS (
  SELECT *, count(*) FILTER (key <> '') OVER (PARTITION BY source_key, seg ORDER BY line_no) AS occ,
    CASE WHEN key <> '' THEN trim(regexp_extract(line, ':(.*)$', 1)) ELSE trim(line) END AS piece
  FROM head_lines),
headers AS (
  SELECT source_key, seg, occ, CASE max(key) WHEN 'sent' THEN 'date' ELSE max(key) END AS key,
    trim(string_agg(piece, ' ' ORDER BY line_no)) AS value
  FROM occurrences GROUP BY 1, 2, 3),
latest AS (
  SELECT source_key, seg,
    coalesce(arg_max(value, occ) FILTER (key = 'from'), '') AS from_,
    coalesce(arg_max(value, occ) FILTER (key = 'to'), '') AS to_,
    coalesce(arg_max(value, occ) FILTER (key = 'cc'), '') AS cc,
    coalesce(arg_max(value, occ) FILTER (key = 'subject'), '') AS subject,
    coalesce(arg_max(value, occ) FILTER (key = 'date'), '') AS date_header
  FROM headers GROUP BY 1, 2),
texts AS (
  SELECT s.source_key, s.seg,
    string_agg(line, chr(10) ORDER BY line_no) AS whole,
    string_agg(line, chr(10) ORDER BY line_no) FILTER (s.seg = 0 OR line_no > b.blank) AS rest
  FROM segs s LEFT JOIN blanks b USING (source_key, seg) GROUP BY 1, 2),
trimmed AS (
  SELECT *, """
    + _strip_junk("coalesce(rest, '')")
    + r""" AS body FROM texts),
raw_units AS (
  SELECT source_key, CAST(row_number() OVER (PARTITION BY source_key ORDER BY seg) - 1 AS BIGINT) AS unit_order,
    seg, seg = 0 AS is_wrapper,
    contains(lower(CASE WHEN seg = 0 THEN body ELSE whole END), 'external email') AS is_external, body
  FROM trimmed WHERE body <> ''),
units AS (
  SELECT u.source_key, u.unit_order, u.is_wrapper, u.is_external, u.body, m.modification_time, m.conv_id, m.turn,
    CASE WHEN is_wrapper THEN m.message_id END AS message_id,
    CASE WHEN is_wrapper THEN coalesce(m.from_, '') ELSE h.from_ END AS from_,
    CASE WHEN is_wrapper THEN coalesce(m.to_, '') ELSE h.to_ END AS to_,
    CASE WHEN is_wrapper THEN coalesce(m.cc, '') ELSE h.cc END AS cc,
    CASE WHEN is_wrapper THEN coalesce(m.subject, '') ELSE h.subject END AS subject,
    CASE WHEN is_wrapper THEN coalesce(m.date_header, '') ELSE h.date_header END AS date_header,
    m.date_header AS envelope_date
  FROM raw_units u JOIN mailbox m USING (source_key) LEFT JOIN latest h USING (source_key, seg))
"""
)

_NORMAL_BODY = f"lower({_collapse('body')})"


def _identity(mid: str = "message_id") -> str:
    folded = ", ".join(f"lower({_trim(c)})" for c in ("from_", "date_header", "subject"))
    digest = f"concat('sha256:', sha256(concat_ws(chr(10), {folded}, {_NORMAL_BODY})))"
    return f"CASE WHEN coalesce(trim({mid}), '') <> '' THEN trim({mid}) ELSE {digest} END"


# The two shapes of date in the mailbox, read field by field.
_RFC = r"'^[A-Za-z]+, ([0-9]+ [A-Za-z]+ [0-9]+ [0-9:]+) ([+-])([0-9]{2})([0-9]{2})$'"
_QUOTED = r"'^[A-Za-z]+, ([A-Za-z]+ [0-9]+, [0-9]+ [0-9]+:[0-9]+) [AP]M$'"


def _sent(x: str) -> str:
    def part(i: int) -> str:
        return f"regexp_extract({x}, {_RFC}, {i})"

    minutes = f"(CAST({part(3)} AS INT) * 60 + CAST({part(4)} AS INT)) * CAST(concat({part(2)}, '1') AS INT)"
    return (
        f"CASE WHEN regexp_matches({x}, {_RFC}) THEN strptime({part(1)}, '%d %b %Y %H:%M:%S') - to_minutes({minutes}) "
        f"WHEN regexp_matches({x}, {_QUOTED}) THEN strptime(regexp_extract({x}, {_QUOTED}, 1), '%B %d, %Y %H:%M') END"
    )


def _stamp(x: str) -> str:
    return f"coalesce(strftime({x}, '%Y%m%dT%H%M%SZ'), '00000000T000000Z')"


_KEY_DATE = "coalesce(nullif(regexp_extract(source_key, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), ''), 'undated')"

IDENTIFIED = f"""
identified AS (SELECT *, {_identity()} AS identity FROM units),
addressed AS (
  SELECT *, concat('emails-extracted/content/', send_date, '/', thread, '__', sent_text, '__', slug, '__', hash8, '.md') AS output_key
  FROM (
    SELECT *, sha256(identity)[1:8] AS hash8, {_thread('subject')} AS thread, {_slug('subject')} AS slug,
      {_stamp(_sent('date_header'))} AS sent_text,
      coalesce(strftime({_sent('envelope_date')}, '%Y-%m-%d'), {_KEY_DATE}) AS send_date
    FROM identified))
"""

CLAIMED = """
claimed AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY identity ORDER BY modification_time, source_key, unit_order) AS rn,
      count(*) OVER (PARTITION BY identity) AS copies
    FROM addressed) WHERE rn = 1)
"""

_MAIL = (MAILBOX,)
_LINES = (MAILBOX, LINES)
_SEGS = (MAILBOX, LINES, SEGMENTS)
_UNITS = (MAILBOX, LINES, SEGMENTS, UNITS)
_ADDRESSED = (*_UNITS, IDENTIFIED)
_CLAIMED = (*_ADDRESSED, CLAIMED)

_PAGE = f"""
concat('# ', CASE WHEN subject <> '' THEN subject ELSE '(no subject)' END, {_NL}, {_NL},
  CASE WHEN is_external THEN concat('> **EXTERNAL EMAIL**', {_NL}, {_NL}) ELSE '' END,
  CASE WHEN from_ <> '' THEN concat('**From:** ', from_, '  ', {_NL}) ELSE '' END,
  CASE WHEN to_ <> '' THEN concat('**To:** ', to_, '  ', {_NL}) ELSE '' END,
  CASE WHEN cc <> '' THEN concat('**Cc:** ', cc, '  ', {_NL}) ELSE '' END,
  CASE WHEN date_header <> '' THEN concat('**Date:** ', date_header, '  ', {_NL}) ELSE '' END,
  {_NL}, '---', {_NL}, {_NL}, {_trim('body')}, {_NL})
"""

_FILES = """
files AS (
  SELECT *, concat(event_type, ' v1.', user_id, ' é',
    ['.pdf', '.PPTX', '.tar.gz', '.txt', '', '.Csv', '.xlsx', '.md'][CAST(event_id % 8 AS INT) + 1]) AS filename
  FROM events)
"""

def _part(key: str, number: str) -> str:
    return f"sha256(concat({key}, '/', {number}))[1:16]"


_ORDERS = f"""
parts AS (
  SELECT concat('emails/2024-01-01/ORDER', l_orderkey, '==.eml') AS source_key, l_orderkey, l_linenumber AS part_no,
    concat('Item ', l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN '.txt' ELSE '.PDF' END) AS filename,
    CASE WHEN l_linenumber % 2 = 0 THEN 'text/plain' ELSE 'application/pdf' END AS content_type
  FROM lineitem),
tops AS (
  SELECT concat('emails/2024-01-01/ORDER', o_orderkey, '==.eml') AS source_key, {_thread('o_orderpriority')} AS thread,
    o_orderdate AS sent_at, strftime(o_orderdate, '%Y-%m-%d') AS send_date
  FROM orders WHERE o_orderstatus <> 'O'),
owned AS (
  SELECT p.*, thread, sent_at, send_date,
    concat('emails-extracted/attachments/', send_date, '/', thread, '__', strftime(sent_at, '%Y%m%dT%H%M%SZ'), '__',
      {_slug("regexp_replace(regexp_replace(source_key, '.*/', ''), '.eml$', '')", 40)}, '__', {_slug('filename')}, '__', {_part('source_key', 'part_no')}, '.md') AS output_key
  FROM parts p JOIN tops USING (source_key))
"""

_ESCAPED = r"""array_to_string(list_transform(regexp_extract_all(x, '<[^>]*>|[^<]+'),
  lambda t: CASE WHEN t LIKE '<%' THEN t ELSE regexp_replace(t, '([*_])', '\\\1', 'g') END), '')"""

_BLOCK_TAGS = "p|div|article|section|ul|ol|blockquote"
_SPACED = _BLOCK_TAGS + "|li|h[1-6]|table|thead|tbody|tr|td|th|br|hr|html|body|nav|header|footer|main"

_HTML_STEPS = (
    (r"<!--.*?-->", ""),
    (r"<script(\s[^>]*)?>.*?</script>", ""),
    (r"<style(\s[^>]*)?>.*?</style>", ""),
    (r"<head(\s[^>]*)?>.*?</head>", ""),
    (r"<title(\s[^>]*)?>.*?</title>", ""),
    (r"[ \t\r\n]*[\r\n][ \t\r\n]*", "\n"),
    (r"[ \t]+", " "),
    (rf"\s*(</?({_SPACED})(\s[^>]*)?/?>)\s*", r"\1"),
    None,
    (r"<br/?>", "  \n"),
    (r"<(b|strong)>(\s*)([^<]*[^<\s])(\s*)</(b|strong)>", r"\2**\3**\4"),
    (r"""<a href="([^"]*)">(\s*)([^<]*[^<\s])(\s*)</a>""", r"\2[\3](\1)\4"),
    (r"<h1(\s[^>]*)?>", "\n\n# "),
    (r"</h1>", "\n\n"),
    (r"</li>", "\n"),
    (r"<li(\s[^>]*)?>", "* "),
    (rf"</?({_BLOCK_TAGS})(\s[^>]*)?/?>", "\n\n"),
    (r"<[!?/a-z][^>]*>", ""),
    (r"\n{3,}", "\n\n"),
)


def _html() -> str:
    ctes, last = [], "SELECT page_id, url, html AS x FROM pages"
    for i, step in enumerate(_HTML_STEPS):
        if step is None:
            change = _ESCAPED
        else:
            pattern, to = (x.replace("'", "''").replace("\n", "\\n") if k == 0 else x for k, x in enumerate(step))
            text = "'" + to.replace("\n", "'||chr(10)||'") + "'"
            change = f"regexp_replace(x, '{pattern}', {text}, 'gis')"
        ctes.append(f"h{i} AS (SELECT page_id, url, {change} AS x FROM ({last}))")
        last = f"SELECT * FROM h{i}"
    x = "x"
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    ctes.append(f"md AS (SELECT page_id, url, {_trim(x)} AS markdown FROM ({last}))")
    return ",\n".join(ctes)


_SHAPED = """
shaped AS (
  SELECT event_id, ts, date_trunc('second', ts) AS sec, date_trunc('minute', ts) AS mi, event_id % 8 AS shape,
    to_hours(CASE WHEN hour(ts) >= 12 THEN 12 ELSE 0 END) AS late,
    to_hours(CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE 0 END) AS twelve
  FROM events),
dated AS (
  SELECT event_id, CASE shape
    WHEN 0 THEN sec + INTERVAL 210 MINUTE
    WHEN 1 THEN mi + INTERVAL 5 HOUR
    WHEN 2 THEN mi - late + twelve
    WHEN 3 THEN sec + INTERVAL 7 HOUR
    WHEN 4 THEN sec
    WHEN 5 THEN sec END AS sent_at,
    CASE shape
    WHEN 0 THEN sec + INTERVAL 210 MINUTE
    WHEN 1 THEN mi + INTERVAL 5 HOUR
    WHEN 2 THEN mi
    WHEN 3 THEN sec + INTERVAL 7 HOUR
    WHEN 4 THEN sec
    WHEN 5 THEN sec END AS sent_at_12h
  FROM shaped)
"""

_ENCODED = f"texts AS (SELECT doc_id, {_trim('text')} AS text, octet_length(encode(text)) AS n FROM documents)"

_DOC_LINES = """
doc_lines AS (
  SELECT doc_id, CAST(i - 1 AS BIGINT) AS line_no, l[i] AS text
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, CASE WHEN text = '' THEN [] ELSE string_split(regexp_replace(text, '\\n$', ''), chr(10)) END AS l
              FROM documents)))
"""

_SUBJECTS = """
marked AS (
  SELECT doc_id, concat(['', 'Re: ', ' FW:fwd : ', 'AW [12]: re:', 'Sv:VS: wg [3] : ', 'Recap: '][CAST(doc_id % 6 AS INT) + 1],
    text) AS s
  FROM documents)
"""

_CELL = "concat('| ', array_to_string(list_transform(c, lambda x: replace(replace(coalesce(x, ''), '|', '\\|'), chr(10), ' ')), ' | '), ' |')"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    u = _with(*_UNITS)
    a = _with(*_ADDRESSED)
    c = _with(*_CLAIMED)

    head = (
        "concat(CASE WHEN message_id IS NULL THEN '' ELSE concat('Message-ID: ', message_id, chr(13) || chr(10)) END, 'From: ', from_, chr(13) || chr(10), "
        "'To: ', to_, chr(13) || chr(10), CASE WHEN cc IS NULL THEN '' ELSE concat('Cc: ', cc, chr(13) || chr(10)) END, 'Subject: ', subject, chr(13) || chr(10), "
        "CASE WHEN date_header IS NULL THEN '' ELSE concat('Date: ', date_header, chr(13) || chr(10)) END, 'MIME-Version: 1.0', chr(13) || chr(10), "
        "'Content-Type: text/plain; charset=utf-8', chr(13) || chr(10), 'Content-Transfer-Encoding: 8bit', chr(13) || chr(10) || chr(13) || chr(10), body)"
    )
    sql["scan_messages"] = _with(*_MAIL) + f"SELECT source_key, CAST(octet_length(encode({head})) AS BIGINT) AS length FROM mailbox"
    sql["flatten_events"] = r"""
WITH queue AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id,
    CASE event_id % 10 WHEN 0 THEN '{"Event": "s3:TestEvent"}' WHEN 1 THEN concat('not json ', props)
      WHEN 2 THEN concat('{"Records": [', props, ']}')
      ELSE concat('{"Records": [', rec1, CASE WHEN event_id % 10 = 3 THEN concat(',', replace(rec1, '.eml', '%20b.eml')) ELSE '' END, ']}') END AS body
  FROM (SELECT *, concat('{"s3":{"bucket":{"name":"', event_type, '"},"object":{"key":"emails/', strftime(ts, '%Y-%m-%d'), '/u+',
          user_id, '%3D', event_id, '.eml"}}}') AS rec1 FROM events)),
records AS (
  SELECT message_id, unnest(CAST(json_extract(body, '$.Records') AS JSON[])) AS r
  FROM queue WHERE json_valid(body))
SELECT message_id, json_extract_string(r, '$.s3.bucket.name') AS bucket,
  url_decode(replace(json_extract_string(r, '$.s3.object.key'), '+', ' ')) AS key
FROM records WHERE json_extract(r, '$.s3') IS NOT NULL"""
    sql["date_from_key"] = _with(*_MAIL) + f"SELECT source_key, {_KEY_DATE} AS key_date FROM mailbox"
    sql["key_stem"] = _with(*_MAIL) + (
        "SELECT source_key, regexp_replace(regexp_replace(CASE WHEN turn % 2 = 0 THEN upper(source_key) ELSE source_key END, "
        "'.*/', ''), '[.]eml$', '', 'i') AS stem FROM mailbox"
    )
    sql["backfill_select"] = _with(*_MAIL) + (
        "SELECT * FROM (SELECT replace(source_key, '.eml', CASE turn % 3 WHEN 0 THEN '.eml' WHEN 1 THEN '.EML' ELSE '.txt' END) AS source_key "
        "FROM mailbox) WHERE starts_with(source_key, 'emails/2026-07-0') AND lower(source_key) LIKE '%.eml'"
    )
    sql["assign_chunks"] = (
        "SELECT user_id, event_id, position, position // 10 AS chunk_no FROM "
        "(SELECT user_id, event_id, row_number() OVER (ORDER BY user_id, event_id) - 1 AS position FROM events)"
    )
    sql["chunk_report"] = (
        "SELECT n // 1000 AS chunk_no, count(*) AS sent, count(*) FILTER (event_type <> 'error') AS accepted FROM "
        "(SELECT event_type, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events) GROUP BY 1"
    )
    sql["write_content"] = c + f"SELECT output_key, {_PAGE} AS markdown, send_date FROM claimed"
    stem = _slug("regexp_replace(regexp_replace(c.source_key, '.*/', ''), '.eml$', '')", 40)
    sql["write_attachments"] = c + f"""
SELECT concat('emails-extracted/attachments/', send_date, '/', thread, '__', sent_text, '__', {stem}, '__', {_slug("filename")}, '__', {_part('c.source_key', '0')}, '.md') AS output_key,
  concat('# Attachment: ', filename, chr(10), chr(10), '**Source email:** `', c.source_key, '`  ', chr(10), '**Content type:** text/plain  ',
    chr(10), chr(10), '---', chr(10), chr(10), {_trim("m.body")}, chr(10)) AS markdown, send_date, filename
FROM claimed c JOIN (SELECT source_key, body, concat(subject, '.TXT') AS filename FROM mailbox) m ON m.source_key = c.source_key
WHERE c.unit_order = 0"""
    sql["sidecar_key"] = _with(_FILES) + (
        "SELECT event_id, CASE WHEN filename LIKE '%.md' THEN concat(left(filename, -3), '.json') ELSE concat(filename, '.json') END AS sidecar FROM files"
    )
    sql["export_objects"] = c + (
        f"SELECT output_key, {_PAGE} AS page FROM claimed UNION ALL "
        "SELECT replace(output_key, '.md', '.json') AS output_key, NULL AS page FROM claimed"
    )
    sql["parse_messages"] = _with(*_MAIL) + (
        "SELECT source_key, message_id, from_, to_, cc, subject, date_header, body, false AS body_is_markdown, "
        "CAST(NULL AS VARCHAR) AS error FROM mailbox"
    )
    sql["clean_header"] = (
        f"SELECT doc_id, shape, CASE WHEN shape = 0 THEN nullif({_collapse('text')}, '') END AS header "
        "FROM documents, unnest([0, 1]) AS x(shape)"
    )
    html = "WITH " + _html() + "\n"
    sql["best_body"] = html + (
        "SELECT page_id, shape, CASE WHEN shape = 2 THEN '' WHEN shape = 0 AND trim(url) <> '' THEN url ELSE markdown END AS body, "
        "shape = 1 OR (shape = 0 AND coalesce(trim(url), '') = '') AS is_markdown FROM md, unnest([0, 1, 2]) AS x(shape)"
    )
    sql["html_to_markdown"] = html + "SELECT page_id, markdown FROM md"
    sql["real_attachments"] = _with(_FILES) + """
SELECT CAST(event_id AS VARCHAR) AS source_key, 0 AS part_no, filename FROM files WHERE event_id % 2 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 1, event_type FROM files WHERE event_id % 3 <> 0"""

    sql["thread_lines"] = _with(*_LINES) + "SELECT source_key, line_no, line FROM lines"
    sql["thread_boundaries"] = _with(*_SEGS) + "SELECT source_key, line_no FROM bounds WHERE opens"
    sql["thread_segments"] = _with(*_SEGS) + (
        "SELECT source_key, seg AS segment_no, string_agg(line, chr(10) ORDER BY line_no) AS segment FROM segs GROUP BY 1, 2"
    )
    sql["thread_headers"] = u + (
        "SELECT source_key, unit_order, from_, to_, cc, subject, date_header FROM units WHERE NOT is_wrapper"
    )
    sql["trim_segment"] = f"SELECT doc_id, {_strip_junk('text')} AS segment FROM documents"
    sql["external_flag"] = u + "SELECT source_key, unit_order, is_external FROM units"
    sql["split_threads"] = u + "SELECT source_key, unit_order, is_wrapper, is_external, body FROM units"
    sql["apply_envelope"] = u + (
        "SELECT source_key, unit_order, message_id, from_, to_, cc, subject, date_header, envelope_date FROM units"
    )

    sql["normalize_body"] = f"SELECT doc_id, lower({_collapse('text')}) AS body FROM documents"
    sql["email_identity"] = a + "SELECT source_key, unit_order, identity FROM identified"
    sql["document_identity"] = f"""
WITH d AS (SELECT doc_id, NULL AS message_id, source AS from_, '' AS date_header, lang AS subject, text AS body FROM documents)
SELECT identity, min(doc_id) AS doc_id, count(*) AS copies FROM (SELECT doc_id, {_identity("CAST(message_id AS VARCHAR)")} AS identity FROM d) GROUP BY 1"""
    sql["short_hash"] = "SELECT doc_id, sha256(text)[1:8] AS hash8 FROM documents"
    sql["dedup_first_writer"] = c + (
        "SELECT identity, source_key, unit_order, copies, identity NOT IN "
        "(SELECT identity FROM addressed WHERE starts_with(source_key, 'emails/misc/')) AS is_new FROM claimed"
    )
    sql["claim_stream"] = c + "SELECT identity, thread, sent_text, hash8 FROM claimed"
    sql["ingest_events"] = _with(*_MAIL) + """
SELECT source_key, subject, body, CAST(NULL AS VARCHAR) AS error FROM mailbox WHERE conv_id % 9 <> 4
UNION ALL SELECT source_key, NULL, NULL, 'missing object' FROM mailbox WHERE conv_id % 9 = 4
UNION ALL SELECT NULL, NULL, NULL, 'record without bucket or key'"""
    sql["retry_run"] = _with(*_MAIL) + """
SELECT source_key, CAST(CASE conv_id % 9 WHEN 4 THEN NULL WHEN 5 THEN 2 ELSE 0 END AS INTEGER) AS read_in,
  CAST(CASE conv_id % 9 WHEN 4 THEN 5 WHEN 5 THEN 2 END AS INTEGER) AS failures,
  CASE conv_id % 9 WHEN 4 THEN 'dead' WHEN 5 THEN 'retry' END AS state FROM mailbox"""
    sql["backfill_run"] = _with(*_MAIL) + (
        "SELECT count(*) AS found, count(*) AS sent, CAST(ceil(count(*) / 10) AS BIGINT) AS chunks "
        "FROM mailbox WHERE starts_with(source_key, 'emails/2026-07-0')"
    )
    again = "SELECT DISTINCT identity, thread, sent_text, hash8, CAST(1 AS BIGINT) AS batch_id FROM addressed"
    sql["reprocess"] = a + again
    sql["clear_run"] = a + again + " WHERE starts_with(source_key, 'emails/misc/')"
    sql["registry_rows"] = c + (
        "SELECT identity, 1 AS schema_version, source_key, output_key, subject, date_header, CAST(7 AS BIGINT) AS batch_id FROM claimed"
    )
    sql["registry_select"] = c + "SELECT identity FROM claimed WHERE starts_with(source_key, 'emails/2026-07-02')"
    sql["registry_forget"] = c + (
        "SELECT identity, source_key FROM claimed WHERE NOT starts_with(source_key, 'emails/misc/')"
    )

    sql["attachment_kind"] = _with(_FILES) + """
SELECT event_id, CASE WHEN e IN ('pdf', 'pptx', 'xlsx', 'docx') THEN e WHEN e IN ('txt', 'csv', 'log', 'md') THEN 'text' END AS kind
FROM (SELECT event_id, lower(regexp_extract(filename, '[.]([^.]*)$', 1)) AS e FROM files)"""
    sql["attachment_size_guard"] = "SELECT doc_id, octet_length(encode(text)) <= 2000 AS kept FROM documents"
    sql["decode_text"] = f"WITH {_ENCODED} SELECT doc_id, text FROM texts"
    order = "l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus"
    sql["rows_to_markdown"] = f"""
WITH cells AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) - 1 AS row_no,
    list_concat([CAST(l_partkey AS VARCHAR), concat(l_returnflag, '|', l_linestatus), concat(l_suppkey, chr(10), 'x'), NULL],
      CASE WHEN l_partkey % 5 = 0 THEN ['more'] ELSE [] END) AS c FROM lineitem),
wide AS (SELECT *, max(len(c)) OVER (PARTITION BY l_orderkey) AS w FROM cells),
padded AS (SELECT l_orderkey, row_no, w, list_concat(c, list_transform(range(w - len(c)), lambda i: '')) AS c FROM wide)
SELECT l_orderkey, string_agg(concat({_CELL}, CASE WHEN row_no = 0 THEN concat(chr(10), '| ',
  array_to_string(list_transform(range(w), lambda i: '---'), ' | '), ' |') ELSE '' END), chr(10) ORDER BY row_no) AS markdown
FROM padded GROUP BY 1"""
    sql["sheet_documents"] = f"""
WITH cells AS (
  SELECT l_orderkey AS doc_id, ascii(l_returnflag) AS section_no, l_returnflag AS title,
    2 * (row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) - 1) AS row_no,
    [CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_linestatus] AS c FROM lineitem),
placed AS (SELECT *, row_no = min(row_no) OVER (PARTITION BY doc_id, section_no) AS first FROM cells),
sheets AS (
  SELECT doc_id, section_no, concat('## ', title, chr(10), chr(10), string_agg(concat({_CELL},
      CASE WHEN first THEN concat(chr(10), '| --- | --- | --- |') ELSE '' END), chr(10) ORDER BY row_no)) AS md,
    concat('{{"sheet":"', title, '","rows":[', string_agg(concat('[', c[1], ',', c[2], ',"', c[3], '"]'), ',' ORDER BY row_no), ']}}') AS js
  FROM placed GROUP BY doc_id, section_no, title)
SELECT doc_id, string_agg(md, chr(10) || chr(10) ORDER BY section_no) AS markdown,
  concat('{{"sheets":[', string_agg(js, ',' ORDER BY section_no), ']}}') AS data FROM sheets GROUP BY 1"""
    sql["paragraph_documents"] = _with(_DOC_LINES) + f"""
SELECT doc_id, coalesce(string_agg({_trim('text')}, chr(10) || chr(10) ORDER BY line_no % 5 = 2, line_no) FILTER ({_trim('text')} <> ''), '') AS markdown
FROM doc_lines GROUP BY 1"""
    decks = f"""
decks AS (
  SELECT conv_id AS doc_id, turn + 1 AS section_no, place, CAST(CASE WHEN place = 1 THEN 1 ELSE 0 END AS BIGINT) AS block_no,
    CASE place WHEN 0 THEN concat('## Slide ', turn + 1) WHEN 1 THEN {_trim('text')} ELSE concat('**Notes:** ', role) END AS piece
  FROM conversations, unnest([0, 1, 2]) AS x(place)),
shown AS (SELECT * FROM decks WHERE piece <> '')"""
    sql["slide_documents"] = sql["write_texts"] = _with(decks) + (
        "SELECT doc_id, string_agg(piece, chr(10) || chr(10) ORDER BY section_no, place, block_no) AS markdown FROM shown GROUP BY 1"
    )
    sql["page_documents"] = _with(_DOC_LINES) + f"""
, texts AS (SELECT doc_id, line_no // 3 + 1 AS section_no, CASE WHEN line_no % 3 = 0 THEN 2 ELSE 1 END AS place, 2 * line_no AS block_no, {_trim('text')} AS piece FROM doc_lines)
SELECT doc_id, string_agg(piece, chr(10) || chr(10) ORDER BY section_no, place, block_no) AS markdown FROM (
  SELECT * FROM texts WHERE piece <> ''
  UNION ALL SELECT DISTINCT doc_id, section_no, 0, CAST(0 AS BIGINT), concat('## Page ', section_no) FROM texts) GROUP BY 1"""
    sql["extract_attachments"] = f"""
WITH encoded AS (
  SELECT doc_id, {_trim('text')} AS text, CAST(doc_id // 4 % 4 AS INT) AS f, doc_id % 4 AS n,
    regexp_full_match(text, '[\\x00-\\x{{7f}}]*') AS ascii, regexp_full_match(text, '[\\x00-\\x{{ff}}\\n]*') AS latin,
    CASE WHEN doc_id % 4 IN (1, 2) THEN 2 + 2 * length(text)
      WHEN doc_id % 4 = 3 AND regexp_full_match(text, '[\\x00-\\x{{ff}}\\n]*') THEN length(text) ELSE octet_length(encode(text)) END AS size
  FROM documents),
judged AS (
  SELECT *, ['text', 'text', NULL, 'pdf'][f + 1] AS kind, false AS oversize,
    f = 3 AND (n IN (1, 2) OR (n = 3 AND latin AND NOT ascii)) AS failed FROM encoded)
SELECT doc_id, kind, oversize, failed,
  CASE WHEN oversize OR failed OR kind IS NULL THEN NULL WHEN kind = 'pdf' THEN concat('## Page 1', chr(10), chr(10), text) ELSE nullif(text, '') END AS markdown
FROM judged"""
    sql["attach_to_top"] = _with(_ORDERS) + "SELECT source_key, part_no, filename, thread, send_date FROM owned"
    sql["attachment_refs"] = _with(_ORDERS) + """
SELECT source_key, concat('[', string_agg(concat('{"filename":"', filename, '","output_key":"', output_key, '","content_type":"', content_type, '"}'),
  ',' ORDER BY part_no, filename), ']') AS refs FROM owned GROUP BY 1"""

    sql["slugify"] = (
        f"SELECT doc_id, shape, {_slug('s')} AS slug60, {_slug('s', 20)} AS slug20 FROM "
        "(SELECT doc_id, shape, CASE WHEN shape = 0 THEN text ELSE '--!!' END AS s FROM documents, unnest([0, 1]) AS x(shape))"
    )
    sql["normalize_subject"] = _with(_SUBJECTS) + f"SELECT doc_id, {_subject('s')} AS subject FROM marked"
    sql["thread_id"] = _with(_SUBJECTS) + f"SELECT doc_id, {_thread('s')} AS thread FROM marked"
    sql["parse_mail_date"] = _with(_SHAPED) + "SELECT * FROM dated"
    sql["format_timestamp"] = _with(_SHAPED) + f"SELECT event_id, {_stamp('sent_at')} AS sent_text FROM dated"
    sql["format_date"] = _with(_SHAPED) + "SELECT event_id, strftime(sent_at, '%Y-%m-%d') AS day FROM dated"
    sql["partition_date"] = _with(*_MAIL) + (
        f"SELECT source_key, coalesce(strftime({_sent('date_header')}, '%Y-%m-%d'), {_KEY_DATE}) AS by_header, {_KEY_DATE} AS by_key FROM mailbox"
    )
    sql["content_key"] = a + "SELECT source_key, unit_order, output_key FROM addressed"
    sql["attachment_key"] = _with(_ORDERS) + "SELECT source_key, part_no, output_key FROM owned"
    sql["render_email"] = u + f"SELECT source_key, unit_order, {_PAGE} AS markdown FROM units"
    sql["email_metadata"] = a + (
        'SELECT 1 AS schema_version, identity, message_id, source_key, output_key, unit_order AS "order", is_wrapper, is_external, '
        'subject, from_ AS "from", to_ AS "to", cc, date_header AS date, 0 AS attachments FROM addressed'
    )
    sql["metadata_json"] = c + (
        "SELECT hash8, '1' AS schema_version, identity, message_id, output_key, CAST(is_wrapper AS VARCHAR) AS is_wrapper, "
        "subject, cc, '[]' AS attachments FROM claimed"
    )
    sql["render_attachment"] = f"""
SELECT doc_id, concat('# Attachment: ', lang, chr(10), chr(10), '**Source email:** `', source, '`  ', chr(10), '**Content type:** text/', lang, '  ',
  chr(10), chr(10), '---', CASE WHEN {_trim('text')} = '' THEN '' ELSE concat(chr(10), chr(10), {_trim('text')}) END, chr(10)) AS markdown FROM documents"""
    sql["attachment_metadata"] = _with(_FILES) + (
        "SELECT event_id, '1' AS schema_version, filename, 'text/plain' AS content_type, event_type AS source_key, "
        "CAST(user_id AS VARCHAR) AS output_key, CASE WHEN event_id % 2 = 0 THEN json_extract_string(props, '$.k') END AS data_k FROM files"
    )

    good = (*_UNITS, IDENTIFIED.replace("FROM units)", "FROM units WHERE conv_id % 13 <> 5)"), CLAIMED)
    sql["run_counters"] = _with(*good, _ORDERS) + """
SELECT (SELECT count(*) FROM mailbox WHERE conv_id % 13 <> 5) AS emails_processed,
  (SELECT count(*) FROM claimed) AS emails_written,
  (SELECT count(*) FROM addressed) - (SELECT count(*) FROM claimed) AS dedup_skips,
  (SELECT count(*) FROM owned WHERE filename LIKE '%.txt') AS attachments_extracted,
  CAST(0 AS BIGINT) AS extraction_failures,
  CAST(0 AS BIGINT) AS decode_errors,
  (SELECT count(*) FROM parts) - (SELECT count(*) FROM owned) AS attachments_unowned"""
    sql["flush_counters"] = c + """
SELECT CAST(b AS BIGINT) AS batch_id, (SELECT count(*) FROM claimed) AS emails_written,
  (SELECT count(*) FROM addressed) - (SELECT count(*) FROM claimed) AS dedup_skips FROM (SELECT unnest([0, 1]) AS b)"""
    sql["quarantine_split"] = (
        "SELECT event_id, CASE WHEN event_type = 'error' AND props IS NOT NULL THEN 'failed' ELSE 'good' END AS side FROM events"
    )
    sql["retry_or_dead"] = """
SELECT concat(user_id, '/', strftime(ts, '%Y-%m')) AS source_key, count(*) AS receives,
  CASE WHEN count(*) < 5 THEN 'retry' ELSE 'dead' END AS state FROM events WHERE event_type = 'error' GROUP BY 1"""
    sql["alarm_windows"] = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, max(CASE WHEN event_type = 'error' THEN user_id ELSE 0 END) AS max_depth,
  CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS sum_errors,
  max(CASE WHEN event_type = 'error' THEN user_id ELSE 0 END) > 0 AS depth_alarm, count(*) FILTER (event_type = 'error') > 0 AS error_alarm
FROM events GROUP BY 1"""
    sql["reconcile"] = c + """
SELECT (SELECT count(*) FROM addressed) AS units, (SELECT count(*) FROM claimed) AS written,
  (SELECT count(*) FROM addressed) - (SELECT count(*) FROM claimed) AS skips, true AS balanced"""
    sql["recent_errors"] = """
SELECT * FROM (SELECT event_id, ts, concat(CASE event_type WHEN 'error' THEN 'Traceback: ' WHEN 'click' THEN 'ValueException ' ELSE 'ok ' END, props) AS message
  FROM events) WHERE regexp_matches(message, 'Exception|Traceback') ORDER BY ts DESC, event_id DESC LIMIT 50"""

    listed = "SELECT send_date, thread, sent_text, hash8, output_key"
    sql["thread_lookup"] = c + (
        "SELECT thread, sent_text, hash8, output_key FROM claimed WHERE thread = sha256('topic 7')[1:8]"
    )
    sql["thread_timeline"] = c + (
        f"{listed}, row_number() OVER (PARTITION BY send_date, thread ORDER BY sent_text, hash8, output_key) AS thread_position FROM claimed"
    )
    sql["clear_outputs_select"] = c + (
        "SELECT output_key FROM claimed WHERE starts_with(output_key, 'emails-extracted/content/2026-07-02/')"
    )
    sql["check_keys"] = c + (
        "SELECT send_date, count(*) AS n_keys, count(*) FILTER (left(hash8, 1) = '0') AS bad_keys FROM claimed GROUP BY 1"
    )
    sql["check_pairs"] = """
WITH k AS (SELECT doc_id, concat(source, '/', doc_id) AS k FROM documents),
s AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'stray' ELSE k END AS k, count(*) AS n FROM k GROUP BY 1)
SELECT k AS stem, CAST(1 AS BIGINT) AS n_pages, CAST(0 AS BIGINT) AS n_sidecars FROM k WHERE doc_id % 5 = 0
UNION ALL SELECT k, 0, n FROM s WHERE k = 'stray'"""
    sql["check_residue"] = """
WITH t AS (
  SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN concat(text, ' a=3D1') WHEN doc_id % 11 = 0 THEN concat('<p class=x>', text)
    WHEN doc_id % 17 = 0 THEN concat(text, chr(195), chr(169)) ELSE text END AS text FROM documents
  UNION ALL SELECT page_id + 1000000000, html FROM pages),
f AS (
  SELECT doc_id, regexp_matches(text, '</?[a-zA-Z][^<>]*>') AS raw_tag, contains(text, '=20') OR contains(text, '=3D') AS quoted_printable,
    contains(text, chr(194)) OR contains(text, concat(chr(226), chr(8364), chr(8482))) OR contains(text, concat(chr(195), chr(169))) AS mojibake FROM t)
SELECT * FROM f WHERE raw_tag OR quoted_printable OR mojibake"""
    sql["check_refs"] = _with(_ORDERS) + (
        "SELECT output_key, count(*) AS n_refs FROM owned WHERE output_key NOT IN "
        "(SELECT output_key FROM owned WHERE content_type = 'application/pdf') GROUP BY 1"
    )
    sql["thread_counts"] = c + (
        "SELECT thread, count(*) AS mails, CAST(sum(copies) AS BIGINT) AS copies, min(output_key) AS first_key, max(sent_text) AS last_sent FROM claimed GROUP BY 1"
    )
    return sql
