"""Shared pieces of the SQL side: the derived tables and the chains of common table expressions on them."""

from __future__ import annotations

# The contract's lists, written out a second time so that a wrong entry in the library shows.
SKIP_LABELS = (
    r"\bdiscount\b", r"rounding", r"total\s*gst", r"sub.?total", r"tax", r"paid", r"total\s*qty", r"total\s*item", r"change", r"cash",
    r"tendered",
)
TOTAL_LABELS = (
    (r"total\s*payable", 4000), (r"net\s*payable", 3950), (r"amount\s*payable", 3900), (r"amount\s*due", 3850), (r"balance\s*due", 3800),
    (r"rounded\s*total\s*\(?rm\)?", 3200), (r"total\s*rounded", 3100), (r"grand\s*total", 3100), (r"total\s*sales\s*[\(\[]?inclu", 2900),
    (r"total\s*amount", 2500), (r"total\s*sales", 2400), (r"total\s*amt", 2300), (r"total\s*gross", 2200), (r"\btotal\b", 2000),
)
POSITIVE_WORDS = (
    "enterprise", "trading", "store", "mart", "supermarket", "restaurant", "restoran", "cafe", "bakery", "coffee", "shop", "sdn bhd", "sdn. bhd",
    "bhd", "ltd", "limited", "co.", "hardware", "machinery", "motor", "perniagaan", "gift", "deco",
)
NEGATIVE_PHRASES = (
    "tax invoice", "simplified tax invoice", "invoice", "receipt", "cash bill", "cash sales", "tel:", "fax:", "gst", "reg no", "co.reg", "date",
    "time", "cashier", "salesperson", "member", "thank you", "welcome", "change:", "cash:", "amount", "jalan", "jln", "road", "street", "lane",
    "drive", "taman", "tmn", "bandar", "lot ", "block", "johor", "selangor", "kuala lumpur", "shah alam", "seri kembangan", "petaling jaya",
)

WORDS = """
o AS (
  SELECT o_orderkey AS k, o_totalprice AS tot, c_mktsegment AS seg,
         strftime(o_orderdate, '%d') AS dd, strftime(o_orderdate, '%m') AS mm, strftime(o_orderdate, '%Y') AS yyyy
  FROM orders JOIN customer ON o_custkey = c_custkey),
li AS (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
t AS (
  SELECT k, 0 AS line_no, 0 AS pos, seg AS text FROM o
  UNION ALL SELECT k, 0, 1, CASE k % 5 WHEN 0 THEN 'TRADING' WHEN 1 THEN 'Enterprise' WHEN 2 THEN 'MART'
                                       WHEN 3 THEN 'RESTAURANT' ELSE 'holdings' END FROM o
  UNION ALL SELECT k, 0, 2, CASE k % 3 WHEN 0 THEN 'SDN' WHEN 1 THEN 'LTD' ELSE 'CO.' END FROM o
  UNION ALL SELECT k, 0, 3, 'BHD' FROM o WHERE k % 3 = 0
  UNION ALL SELECT k, 1, 0, 'No' FROM o UNION ALL SELECT k, 1, 1, '12' FROM o UNION ALL SELECT k, 1, 2, 'JALAN' FROM o
  UNION ALL SELECT k, 2, 0, 'Invoice' FROM o
  UNION ALL SELECT k, 2, 1, CASE k % 6 WHEN 0 THEN dd || '/' || mm || '/' || yyyy
                                       WHEN 1 THEN 'Date:' || dd || '/' || mm || '/' || yyyy
                                       WHEN 2 THEN dd || '-' || mm || '-' || substr(yyyy, 3, 2)
                                       WHEN 3 THEN yyyy || '-' || mm || '-' || dd
                                       WHEN 4 THEN mm || '/' || dd || '/' || yyyy
                                       ELSE '31/02/2018' END FROM o WHERE k % 13 <> 0
  UNION ALL SELECT l_orderkey, 2 + l_linenumber, 0, 'ITEM' FROM li
  UNION ALL SELECT l_orderkey, 2 + l_linenumber, 1, CAST(CAST(price AS decimal(12,2)) AS string) FROM li
  UNION ALL SELECT k, 20, 0, 'SUBTOTAL' FROM o
  UNION ALL SELECT k, 20, 1, CAST(CAST(tot AS decimal(12,2)) AS string) FROM o
  UNION ALL SELECT k, 21, 0, CASE k % 7 WHEN 0 THEN 'GRAND' WHEN 1 THEN 'NET' WHEN 2 THEN 'AMOUNT'
                                        WHEN 3 THEN 'ROUNDED' ELSE 'THE' END FROM o
  UNION ALL SELECT k, 21, 1, CASE k % 7 WHEN 1 THEN 'PAYABLE' WHEN 2 THEN 'DUE' ELSE 'TOTAL' END FROM o
  UNION ALL SELECT k, 21, 2, CASE WHEN k % 7 = 3 THEN 'RM' ELSE '' END || CAST(CAST(tot AS decimal(12,2)) AS string)
            FROM o WHERE k % 17 <> 0
  UNION ALL SELECT k, 22, 0, 'CASH' FROM o
  UNION ALL SELECT k, 22, 1, CAST(CAST(tot AS decimal(12,2)) + 10 AS string) FROM o
  UNION ALL SELECT k, 23, 0, '  ' FROM o WHERE k % 10 = 0),
words AS (
  SELECT k AS doc_id, CAST(line_no * 100 + pos AS int) AS word_id, text,
         CASE WHEN (k + line_no * 3 + pos) % 41 = 0 THEN -1 WHEN (k + line_no * 3 + pos) % 37 = 0 THEN 5
              ELSE CAST(30 + (k * 7 + line_no * 13 + pos * 29) % 70 AS int) END AS conf,
         20 + 90 * pos AS x, 20 + 40 * line_no + (pos % 3) * 4 AS y, CAST(10 * length(text) AS int) AS w,
         CASE WHEN k % 11 = 0 AND line_no = 0 AND pos = 1 THEN 90 ELSE 20 END AS h, 980 AS page_h
  FROM t)
"""



def _with(more: str) -> str:
    """WORDS with the further texts of ``more`` (k, line_no, pos, text)."""
    return WORDS.replace("words AS (", f"more AS (SELECT k, line_no, pos, text FROM t UNION ALL {more}),\nwords AS (").replace("FROM t)\n", "FROM more)\n")


def _less(n: int) -> str:
    return f"CAST(CAST(tot AS decimal(12,2)) - {n} AS string)"


CONTESTED_TOTALS = _with(f"""
  SELECT k, CAST(unnest(range(24, 32)) AS int), 0, 'ITEM' FROM o
  UNION ALL SELECT k, 32, 0, 'AMOUNT' FROM o UNION ALL SELECT k, 32, 1, 'PAYABLE' FROM o UNION ALL SELECT k, 32, 2, {_less(4)} FROM o
  UNION ALL SELECT k, 33, 0, 'TOTAL' FROM o WHERE k % 2 = 0 UNION ALL SELECT k, 33, 1, 'AMOUNT' FROM o WHERE k % 2 = 0
  UNION ALL SELECT k, 33, 2, {_less(2)} FROM o WHERE k % 2 = 0
  UNION ALL SELECT k, 34, 0, 'Balance' FROM o WHERE k % 3 = 0 UNION ALL SELECT k, 34, 1, 'due' FROM o WHERE k % 3 = 0
  UNION ALL SELECT k, 34, 2, {_less(8)} FROM o WHERE k % 3 = 0""")
CONTESTED_DATES = _with("""
  SELECT k, 1, 3, 'InvoiceDate:05/06/2017' FROM o WHERE k % 4 = 0
  UNION ALL SELECT k, 1, 4, '2016/07/08' FROM o WHERE k % 3 = 0
  UNION ALL SELECT k, 2, 2, CASE k % 5 WHEN 0 THEN '12 Mar 2019' WHEN 1 THEN 'March 3, 2018' ELSE '日期:7/8/2018' END FROM o WHERE k % 5 < 3
  UNION ALL SELECT k, 1, 5, '01/02/2018' FROM o WHERE k % 6 = 1
  UNION ALL SELECT k, 1, 215, '03/04/2018' FROM o WHERE k % 6 = 1""").replace("words AS (", "boxed AS (") + """,
words AS (SELECT * REPLACE (CASE WHEN lost THEN NULL ELSE x END AS x, CASE WHEN lost THEN NULL ELSE y END AS y,
    CASE WHEN lost THEN NULL ELSE w END AS w, CASE WHEN lost THEN NULL ELSE h END AS h) FROM (SELECT *, doc_id % 9 = 0 AND word_id = 201 AS lost FROM boxed))
"""

JOBS = """
jobs AS (
  SELECT CAST(o_orderkey AS string) AS job_id, 'images/' || CAST(o_orderkey AS string) || '.jpg' AS image_path,
         CASE WHEN o_orderkey % 10 < 6 THEN c_mktsegment END AS vendor,
         CASE WHEN o_orderkey % 10 < 6 THEN strftime(o_orderdate, '%Y-%m-%d') END AS invoice_date,
         CASE WHEN o_orderkey % 10 < 6 THEN o_totalprice END AS total_amount,
         CASE WHEN o_orderkey % 10 < 6 THEN CAST(o_orderkey % 100 AS double) / 100 END AS confidence,
         CASE WHEN o_orderkey % 10 < 4 THEN 'OCR_RULE' WHEN o_orderkey % 10 = 4 THEN 'LLM'
              WHEN o_orderkey % 10 = 5 THEN 'HUMAN' END AS source,
         CASE WHEN o_orderkey % 10 < 6 THEN 'SUCCESS' WHEN o_orderkey % 10 < 8 THEN 'NEEDS_REVIEW'
              WHEN o_orderkey % 20 = 8 THEN 'DLQ' WHEN o_orderkey % 20 = 18 THEN 'OCR_DONE' ELSE 'LLM_PENDING' END AS status,
         CAST(CASE WHEN o_orderkey % 10 BETWEEN 6 AND 8 THEN 2 ELSE o_orderkey % 2 END AS int) AS retry_count,
         2 AS max_retries,
         CASE WHEN o_orderkey % 10 = 6 THEN 'validation_failed_after_retry:date_in_future'
              WHEN o_orderkey % 10 = 7 THEN 'llm_parse_failed_after_retry' WHEN o_orderkey % 20 = 8 THEN '  '
              WHEN o_orderkey % 20 = 18 THEN repeat('x', 130) END AS last_error,
         o_orderkey % 9 <> 0 AS has_ocr_snapshot, o_orderdate AS updated_at, o_orderkey AS k
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""

RESPONSES = """
items AS (
  SELECT o_orderkey AS k, o_orderkey - o_orderkey % 3 AS batch_id,
         '{"job_id": "' || CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE CAST(o_orderkey AS string) END
         || '", "vendor": "' || c_mktsegment || '", "total": '
         || CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_totalprice AS decimal(12,2)) AS string)
                                WHEN 1 THEN '"RM ' || CAST(CAST(o_totalprice AS decimal(12,2)) AS string) || '"'
                                WHEN 2 THEN 'null' ELSE '"n/a"' END
         || ', "date": "' || strftime(o_orderdate, '%Y-%m-%d') || '"}' AS item
  FROM orders JOIN customer ON o_custkey = c_custkey),
responses AS (
  SELECT batch_id,
         CASE WHEN batch_id % 23 = 0 THEN 'sorry, no JSON here' WHEN batch_id % 5 = 0 THEN 'Here it is: ' ELSE '' END
         || CASE WHEN batch_id % 23 = 0 THEN '' ELSE
         '{"results": [' || coalesce(max(CASE WHEN k % 3 = 0 THEN item END), 'null')
         || ', ' || coalesce(max(CASE WHEN k % 3 = 1 THEN item END), 'null')
         || ', ' || coalesce(max(CASE WHEN k % 3 = 2 THEN item END), 'null') || ']}' END AS response
  FROM items GROUP BY batch_id),
requests AS (
  SELECT o_orderkey - o_orderkey % 3 AS batch_id, CAST(o_orderkey AS string) AS job_id, o_orderkey AS k,
         'images/' || CAST(o_orderkey AS string) || '.jpg' AS file,
         CASE o_orderkey % 4 WHEN 0 THEN 'default' WHEN 1 THEN 'strict_json' WHEN 2 THEN 'after_validation_fail'
              ELSE CASE WHEN o_orderkey % 8 = 3 THEN 'ocr_retry' ELSE 'other' END END AS strategy,
         o_orderdate AS arrival
  FROM orders JOIN customer ON o_custkey = c_custkey),
spans AS (SELECT batch_id, nullif(regexp_extract(response, '(?s)\\{.*\\}', 0), '') AS span FROM responses),
elements AS (
  SELECT batch_id, unnest(from_json(json_extract(span, '$.results'), '["JSON"]')) AS e,
         generate_subscripts(from_json(json_extract(span, '$.results'), '["JSON"]'), 1) AS mi
  FROM spans WHERE json_valid(span)),
parsed AS (
  SELECT batch_id, trim(e ->> '$.job_id') AS job_id, e ->> '$.vendor' AS vendor,
         TRY_CAST(nullif(trim(replace(replace(replace(e ->> '$.total', ',', ''), 'RM', ''), '$', '')), '') AS double) AS total,
         e ->> '$.date' AS date
  FROM elements WHERE json_type(e) = 'OBJECT' AND coalesce(e ->> '$.job_id', '') <> ''
  QUALIFY row_number() OVER (PARTITION BY batch_id, trim(e ->> '$.job_id') ORDER BY mi DESC) = 1)
"""

LABEL = (
    "CASE WHEN regexp_matches({t}, '" + "|".join(SKIP_LABELS) + "') THEN 0 "
    + " ".join(f"WHEN regexp_matches({{t}}, '{p}') THEN {s}" for p, s in TOTAL_LABELS) + " ELSE 0 END"
)

AMOUNT_TEXT = "regexp_replace(replace(replace(regexp_replace(lower(trim(text)), '^rm', ''), 'o', '0'), ',', '.'), '[^0-9.]', '', 'g')"
AMOUNT = (
    f"CASE WHEN regexp_full_match({AMOUNT_TEXT}, '[0-9]+(\\.[0-9]{{1,2}})?') AND TRY_CAST({AMOUNT_TEXT} AS double) >= 1 "
    f"THEN TRY_CAST({AMOUNT_TEXT} AS double) END"
)

TOTALS = f"""
centred AS (SELECT *, y + h // 2 AS cy FROM words WHERE trim(text) <> '' AND conf >= 10),
gaps AS (SELECT *, CASE WHEN cy - lag(cy) OVER (PARTITION BY doc_id ORDER BY cy, word_id) > 14 THEN 1 ELSE 0 END AS brk
         FROM centred),
in_rows AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY doc_id ORDER BY cy, word_id) AS bigint) AS row_ix,
            {AMOUNT} AS amount FROM gaps),
row_texts AS (SELECT doc_id, row_ix, string_agg(trim(text), ' ' ORDER BY x, cy, word_id) AS row_text
              FROM in_rows GROUP BY ALL),
row_amounts AS (SELECT doc_id, row_ix, amount AS val, x, y, w, h FROM in_rows WHERE amount IS NOT NULL
                QUALIFY row_number() OVER (PARTITION BY doc_id, row_ix ORDER BY amount DESC, x, cy, word_id) = 1),
row_labels AS (SELECT *, {LABEL.format(t="lower(row_text)")} AS label FROM row_texts),
total_candidates AS (SELECT doc_id, row_ix, label, label - 5 * row_ix AS score, val, x, y, w, h
                     FROM row_labels JOIN row_amounts USING (doc_id, row_ix) WHERE label > 0),
totals AS (SELECT doc_id, val AS total, least(1e0, score / 3200e0) AS total_conf, x, y, w, h FROM total_candidates
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, row_ix) = 1)
"""

# The written forms of a date by the contract.
DATE_PATTERNS = (
    r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b", r"\b\d{4}[/-]\d{1,2}[/-]\d{1,2}\b",
    r"\b\d{1,2}\s+[A-Za-z]{3,9}\s+\d{2,4}\b", r"\b[A-Za-z]{3,9}\s+\d{1,2},?\s+\d{2,4}\b",
)

NORMAL_DATE = r"""coalesce(strftime(CASE
  WHEN regexp_full_match(raw, '\d{1,2}/\d{1,2}/\d{4}') THEN try_strptime(raw, '%d/%m/%Y')
  WHEN regexp_full_match(raw, '\d{1,2}-\d{1,2}-\d{4}') THEN try_strptime(raw, '%d-%m-%Y')
  WHEN regexp_full_match(raw, '\d{1,2}/\d{1,2}/\d{2}') THEN try_strptime(raw, '%d/%m/%y')
  WHEN regexp_full_match(raw, '\d{1,2}-\d{1,2}-\d{2}') THEN try_strptime(raw, '%d-%m-%y')
  WHEN regexp_full_match(raw, '\d{4}/\d{1,2}/\d{1,2}') THEN try_strptime(raw, '%Y/%m/%d')
  WHEN regexp_full_match(raw, '\d{4}-\d{1,2}-\d{1,2}') THEN try_strptime(raw, '%Y-%m-%d')
  WHEN regexp_full_match(raw, '\d{1,2}\s+[A-Za-z]+\s+\d{4}') THEN coalesce(try_strptime(raw, '%d %b %Y'), try_strptime(raw, '%d %B %Y'))
  WHEN regexp_full_match(raw, '[A-Za-z]+\s+\d{1,2},?\s+\d{4}') THEN coalesce(try_strptime(replace(raw, ',', ''), '%b %d %Y'),
    try_strptime(replace(raw, ',', ''), '%B %d %Y')) END, '%d/%m/%Y'), raw)"""

DATES = f"""
seen AS (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS clean FROM words WHERE trim(text) <> ''),
date_matches AS (
  SELECT doc_id, word_id, conf, x, y, w, h, clean, p, unnest(regexp_extract_all(clean, p)) AS raw,
         generate_subscripts(regexp_extract_all(clean, p), 1) AS mi, pi
  FROM seen, (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(DATE_PATTERNS))}) AS v(pi, p)),
date_scores AS (
  SELECT *, conf / 100e0 AS date_conf,
         (CASE WHEN contains(lower(clean), 'date') THEN 50 ELSE 0 END
          + CASE WHEN contains(lower(clean), 'invoice') THEN 20 ELSE 0 END)
         + greatest(0e0, 100e0 - coalesce(y + h / 2e0, 0) * 0.5e0) + (conf / 100e0) * 20e0 AS score
  FROM date_matches),
dates AS (SELECT doc_id, {NORMAL_DATE} AS date, date_conf, x, y, w, h, raw FROM date_scores
          QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word_id, pi, mi) = 1)
"""


def _any(column: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in phrases) + ")"


VENDORS = f"""
header AS (SELECT *, trim(text) AS token FROM words WHERE trim(text) <> '' AND y < floor(page_h * 0.21e0)),
jumps AS (SELECT *, CASE WHEN abs(y - lag(y) OVER (PARTITION BY doc_id ORDER BY word_id)) >= 15 THEN 1 ELSE 0 END AS brk
          FROM header),
in_lines AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY doc_id ORDER BY word_id) AS bigint) AS line_ix FROM jumps),
header_lines AS (
  SELECT doc_id, line_ix, string_agg(token, ' ' ORDER BY word_id) AS text,
         CAST(coalesce(sum(conf) FILTER (conf >= 0), 0) AS bigint) AS conf_sum, count(*) FILTER (conf >= 0) AS conf_n,
         count(*) AS n_words, CAST(sum(h) AS bigint) AS h_sum, max(h) AS h_max, min(h) AS h_min,
         min(x) AS x1, min(y) AS y1, max(x + w) AS x2, max(y + h) AS y2
  FROM in_lines WHERE line_ix < 8 GROUP BY doc_id, line_ix),
cleaned AS (
  SELECT *, trim(regexp_replace(text, '[^A-Za-z\\s&.''\\-()]', '', 'g')) AS clean,
         conf_n = 0 OR conf_sum / conf_n < 45
         OR (n_words > 1 AND h_max - h_min > h_sum / n_words * 1.5e0) AS unreliable
  FROM header_lines),
vendor_lines AS (
  SELECT doc_id, line_ix, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_ix) - 1 AS int) AS i, clean,
         x1, y1, x2, y2
  FROM cleaned
  WHERE clean <> '' AND NOT unreliable AND length(clean) >= 3 AND NOT {_any("lower(clean)", NEGATIVE_PHRASES)}),
runs AS (
  SELECT a.doc_id, a.i, string_agg(b.clean, ' ' ORDER BY b.i) AS text, min(b.x1) AS x, min(b.y1) AS y,
         max(b.x2) - min(b.x1) AS w, max(b.y2) - min(b.y1) AS h
  FROM vendor_lines a JOIN (VALUES (0), (1), (2)) AS s(n) ON true
  JOIN vendor_lines z ON z.doc_id = a.doc_id AND z.i = a.i + s.n
  JOIN vendor_lines b ON b.doc_id = a.doc_id AND b.i BETWEEN a.i AND z.i
  GROUP BY a.doc_id, a.i, s.n),
measured AS (
  SELECT *, length(text) AS n, length(text) - length(replace(text, ' ', '')) AS spaces,
         CASE WHEN length(regexp_replace(text, '[^A-Za-z]', '', 'g')) = 0 THEN 0e0
              ELSE length(regexp_replace(text, '[^A-Z]', '', 'g')) / length(regexp_replace(text, '[^A-Za-z]', '', 'g')) END AS up,
         {" + ".join(f"CAST(contains(lower(text), '{w}') AS int)" for w in POSITIVE_WORDS)} AS pos
  FROM runs),
vendor_candidates AS (
  SELECT doc_id, i, text, x, y, w, h,
         up * 120 + pos * 40 - CASE WHEN pos = 0 AND up < 0.5 THEN 40 ELSE 0 END
         + CASE WHEN n > 5 AND n < 45 THEN 60 WHEN n > 60 THEN -50 ELSE 0 END
         - CASE WHEN spaces > 5 THEN 30 ELSE 0 END + greatest(0, 50 - 10 * i) + CASE WHEN i < 2 THEN 25 ELSE 0 END AS score
  FROM measured),
vendors AS (
  SELECT doc_id, CASE WHEN score >= 80 THEN text END AS vendor,
         CASE WHEN score >= 80 THEN round(least(1e0, score / 295e0), 3) ELSE 0e0 END AS vendor_conf,
         CASE WHEN score >= 80 THEN x END AS x, CASE WHEN score >= 80 THEN y END AS y,
         CASE WHEN score >= 80 THEN w END AS w, CASE WHEN score >= 80 THEN h END AS h
  FROM vendor_candidates
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, text DESC, x DESC, y DESC, w DESC, h DESC) = 1)
"""

CONFIDENCE = """
doc_conf AS (
  SELECT doc_id, coalesce(sum(conf) FILTER (trim(text) <> '') / (count(*) FILTER (trim(text) <> '') * 100e0), 0e0) AS ocr_conf,
         count(*) FILTER (trim(text) <> '') AS n_words
  FROM words GROUP BY doc_id)
"""

FIELDS = f"""{WORDS}, {TOTALS}, {DATES}, {VENDORS}, {CONFIDENCE},
fields AS (
  SELECT c.doc_id, c.ocr_conf, c.n_words, v.vendor, coalesce(v.vendor_conf, 0e0) AS vendor_conf, t.total,
         coalesce(t.total_conf, 0e0) AS total_conf, d.date, coalesce(d.date_conf, 0e0) AS date_conf
  FROM doc_conf c LEFT JOIN vendors v USING (doc_id) LEFT JOIN totals t USING (doc_id) LEFT JOIN dates d USING (doc_id)),
routed AS (
  SELECT *, CASE WHEN vendor_conf < 0.5 OR total_conf < 0.05 OR date_conf < 0.1 THEN 'LLM' ELSE 'VALIDATE' END AS route
  FROM fields),
rule_payloads AS (
  SELECT CAST(doc_id AS string) AS job_id, vendor, total, date, vendor_conf, total_conf, date_conf,
         (vendor_conf + total_conf + date_conf) / 3e0 AS confidence, 'OCR_RULE' AS source, false AS llm_used, route
  FROM routed)
"""

PARSED_DATE = r"""coalesce(
  CASE WHEN regexp_full_match(trim({d}), '\d{{4}}-\d{{1,2}}-\d{{1,2}}') THEN try_strptime(trim({d}), '%Y-%m-%d') END,
  CASE WHEN regexp_full_match(trim({d}), '\d{{1,2}}/\d{{1,2}}/\d{{4}}') THEN try_strptime(trim({d}), '%d/%m/%Y') END,
  CASE WHEN regexp_full_match(trim({d}), '\d{{1,2}}/\d{{1,2}}/\d{{4}}') THEN try_strptime(trim({d}), '%m/%d/%Y') END)"""


def validated(source: str, today: str) -> str:
    """CTEs ``judged`` and ``validated`` over ``source`` (job_id, vendor, date, total, ...)."""
    number = r"[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?"
    return f"""
judged AS (
  SELECT *, {PARSED_DATE.format(d="date")} AS parsed,
         CASE WHEN vendor IS NULL OR trim(vendor) = '' THEN 'vendor_empty'
              WHEN regexp_full_match(trim(replace(vendor, ',', '')), '{number}') THEN 'vendor_numeric_only' END AS e1
  FROM {source}),
coded AS (
  SELECT *, CASE WHEN date IS NULL THEN 'date_missing' WHEN parsed IS NULL THEN 'date_invalid_format' END AS e2,
         CASE WHEN parsed > DATE '{today}' THEN 'date_in_future' END AS e3,
         CASE WHEN year(parsed) < 1990 THEN 'date_unreasonably_old' END AS e4,
         CASE WHEN total IS NULL THEN 'total_missing' WHEN isnan(total) THEN NULL WHEN total <= 0 THEN 'total_not_positive'
              WHEN total > 1e9 THEN 'total_out_of_range' END AS e5
  FROM judged),
checked AS (
  SELECT *, concat_ws(',', e1, e2, e3, e4, e5) AS rules,
         concat_ws(',', CASE WHEN length(trim(vendor)) < 2 THEN 'vendor_too_short'
                             WHEN length(trim(vendor)) > 100 THEN 'vendor_too_long' END,
                   CASE WHEN isnan(total) THEN 'total_invalid' END) AS shape
  FROM coded),
validated AS (
  SELECT *, CASE WHEN rules <> '' THEN rules ELSE shape END AS errors, rules = '' AND shape = '' AS ok FROM checked)"""


def box(prefix: str = "") -> str:
    return f"{prefix}x AS x, {prefix}y AS y, {prefix}w AS w, {prefix}h AS h"
