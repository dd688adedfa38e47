"""DuckDB twins of the queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

# units and their offsets from the pieces' lengths; runs as islands of consecutive repeats
ORACLE_SQL["op1_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS rid, doc_id, text FROM documents WHERE text IS NOT NULL),
p AS (
    SELECT rid, doc_id, unnest(regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+')) AS piece,
        generate_subscripts(regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+'), 1) AS k FROM d),
o AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY rid ORDER BY k) AS e,
        trim(regexp_replace(lower(piece), '\s+', ' ', 'g'), ' ') AS norm FROM p),
u AS (
    SELECT *, e - length(piece) AS s, row_number() OVER (PARTITION BY rid ORDER BY k) AS unit,
        len(string_split(norm, ' ')) AS words FROM o WHERE norm <> ''),
f AS (
    SELECT *, first_value(doc_id) OVER w AS kept_id, first_value(s) OVER w AS kept_s, row_number() OVER w AS nth
    FROM u WINDOW w AS (PARTITION BY norm ORDER BY rid, unit)),
l AS (
    SELECT rid, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM d),
lo AS (
    SELECT *, sum(length(line) + 1) OVER (PARTITION BY rid ORDER BY line_no) AS line_end,
        trim(regexp_replace(lower(line), '\s+', ' ', 'g'), ' ') AS line_norm FROM l),
ln AS (
    SELECT rid, line_end - length(line) - 1 AS line_start, line_end,
        row_number() OVER (PARTITION BY line_norm ORDER BY rid, line_no) AS nth FROM lo WHERE line_norm <> ''),
m AS (
    SELECT f.*, ln.nth > 1 AS whole FROM f JOIN ln ON ln.rid = f.rid AND f.s >= ln.line_start AND f.s < ln.line_end WHERE f.nth > 1),
r AS (SELECT *, unit - row_number() OVER (PARTITION BY rid ORDER BY unit) AS run FROM m),
long AS (SELECT *, sum(words) OVER (PARTITION BY rid, run) >= 15 AS long FROM r),
k AS (SELECT *, unit - row_number() OVER (PARTITION BY rid ORDER BY unit) AS part FROM long WHERE long OR whole)
SELECT any_value(doc_id) AS doc_id, CAST(min(s) AS INTEGER) AS start_char, CAST(max(e) AS INTEGER) AS end_char,
    CAST(count(*) AS INTEGER) AS n_units, CAST(sum(words) AS INTEGER) AS n_words,
    arg_min(kept_id, unit) AS kept_doc_id, CAST(arg_min(kept_s, unit) AS INTEGER) AS kept_start_char
FROM k GROUP BY rid, part
"""

ORACLE_SQL["op2_url_filter"] = """
WITH rules(r_host, r_path, r_verdict) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
    SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, coalesce(r, '') AS r FROM rest))
SELECT page_id, host, path,
    (SELECT arg_max(r_host || r_path, length(r_host || r_path)) FROM rules
     WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS rule,
    coalesce((SELECT arg_max(r_verdict, length(r_host || r_path)) FROM rules
     WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)), 'allow') AS verdict
FROM parts
"""

ORACLE_SQL["op3_line_dedup"] = r"""
WITH pages_ AS (SELECT row_number() OVER () AS rid, * FROM documents),
lines AS (
    SELECT rid, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS k FROM pages_ WHERE text IS NOT NULL),
clean AS (SELECT *, trim(regexp_replace(line, '[ \t\r\f]+', ' ', 'g'), ' ') AS c FROM lines),
total AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
share AS (
    SELECT source, c FROM clean WHERE c <> '' AND source IS NOT NULL GROUP BY source, c
    HAVING count(DISTINCT rid) > 0.2 * (SELECT n FROM total t WHERE t.source = clean.source)),
marked AS (SELECT clean.*, share.c IS NOT NULL AS gone FROM clean LEFT JOIN share ON clean.source = share.source AND clean.c = share.c),
built AS (
    SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS text,
        CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_removed
    FROM marked GROUP BY rid)
SELECT doc_id, built.text, lang, source, CAST(length(built.text) AS BIGINT) AS n_chars, coalesce(n_removed, 0) AS n_removed
FROM pages_ LEFT JOIN built USING (rid)
"""

# every window that shares a shingle with an item, compared with the item directly
ORACLE_SQL["op10_decontamination"] = r"""
WITH dw AS (
    SELECT rid, doc_id, w, len(w) AS len_w FROM (
        SELECT row_number() OVER () AS rid, doc_id,
            list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
        FROM documents WHERE text IS NOT NULL) WHERE len(w) >= 5),
iw AS (
    SELECT item_id, w, len(w) AS n FROM (
        SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
        FROM benchmark WHERE text IS NOT NULL) WHERE len(w) >= 5),
ds AS (SELECT rid, doc_id, len_w, p, array_to_string(w[p + 1 : p + 5], ' ') AS s
       FROM (SELECT *, unnest(range(0, len_w - 4)) AS p FROM dw)),
isg AS (SELECT item_id, n, q, array_to_string(w[q + 1 : q + 5], ' ') AS s
        FROM (SELECT *, unnest(range(0, n - 4)) AS q FROM iw)),
near AS (
    SELECT DISTINCT ds.rid, ds.doc_id, isg.item_id, isg.n, len_w, st AS start_word
    FROM ds JOIN isg ON ds.s = isg.s, unnest(range(greatest(0, ds.p - isg.n + 5), greatest(0, least(ds.p, len_w - isg.n)) + 1)) AS u(st)),
ws AS (
    SELECT near.rid, near.item_id, near.start_word, ds.s, count(*) AS c FROM near JOIN ds ON ds.rid = near.rid
        AND ds.p >= near.start_word AND ds.p <= near.start_word + least(near.n, near.len_w) - 5
    GROUP BY ALL),
ic AS (SELECT item_id, s, count(*) AS d FROM isg GROUP BY ALL),
common AS (
    SELECT rid, item_id, start_word, sum(least(c, d)) AS k FROM ws JOIN ic USING (item_id, s) GROUP BY ALL),
sim AS (
    SELECT near.*, k / (least(n, len_w) - 4 + n - 4 - k) AS similarity FROM near JOIN common USING (rid, item_id, start_word))
SELECT doc_id, item_id, round(max(similarity), 9) AS similarity,
    CAST(arg_min(start_word, (-similarity, start_word)) AS INTEGER) AS start_word, CAST(any_value(n) AS INTEGER) AS n_words
FROM sim WHERE similarity >= 0.8 GROUP BY rid, doc_id, item_id
"""

# crc32 byte by byte over a table of 256 values; letters of two bytes become one for the edit distance
ORACLE_SQL["op12_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_prepend(v, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY v) AS tab
    FROM range(256) AS t(v)),
found AS (
    SELECT CAST(doc_id AS VARCHAR) AS id,
        unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents WHERE text IS NOT NULL),
seen AS (SELECT id, run, count(*) AS k FROM found WHERE length(run) >= 6 GROUP BY id, run),
bytes AS (
    SELECT *, list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) - 64 AS BIGINT)] END))) AS b FROM seen),
hashed AS (
    SELECT run, k, xor(list_reduce(b, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
typed AS (
    SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n, length(word) AS m,
        translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
            '!"#$%&()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[]^_{|}') AS one
    FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
near AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM words a JOIN words b ON b.m BETWEEN a.m - 1 AND a.m + 1
    WHERE a.word <> b.word AND levenshtein(a.one, b.one) = 1),
best AS (
    SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n, any_value(n) AS n FROM near GROUP BY word),
forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * words.n THEN form END AS form,
        CASE WHEN form_n >= 5 * words.n THEN form_n END AS form_n
    FROM words LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT chain.word, chain.next, forms.form FROM chain JOIN forms ON forms.word = chain.next)
SELECT forms.word, forms.form, chain.root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN chain ON chain.word = forms.word AND chain.next IS NULL
"""

# every window of 400 bytes by its digest; spans as islands of covered bytes
ORACLE_SQL["op13_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
parts AS (
    SELECT rid, k, substr(x, 800 * k + 1, 1600) AS part FROM (SELECT rid, x, unnest(range(0, len(x) // 800)) AS k FROM d WHERE len(x) >= 800)),
w AS (
    SELECT rid, md5(substr(part, 2 * o + 1, 800)) AS h, 400 * k + o AS s
    FROM (SELECT rid, k, part, unnest(range(0, least(400, len(part) // 2 - 399))) AS o FROM parts)),
again AS (SELECT rid, s FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
gaps AS (SELECT rid, s, CASE WHEN s <= lag(s) OVER (PARTITION BY rid ORDER BY s) + 400 THEN 0 ELSE 1 END AS gap FROM again),
runs AS (SELECT rid, s, sum(gap) OVER (PARTITION BY rid ORDER BY s) AS run FROM gaps),
spans AS (SELECT rid, min(s) AS a, max(s) + 400 AS b FROM runs GROUP BY rid, run),
edges AS (SELECT rid, b, lead(a) OVER (PARTITION BY rid ORDER BY a) AS next FROM spans
    UNION ALL SELECT rid, 0, min(a) FROM spans GROUP BY rid),
kept AS (
    SELECT rid, string_agg(substr(x, 2 * b + 1, 2 * (coalesce(next, len(x) // 2) - b)), '' ORDER BY b) AS k FROM edges JOIN d USING (rid) GROUP BY rid),
gone AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY rid)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid) LEFT JOIN gone USING (rid)
"""
