"""What each query must return, stated in SQL straight from the given tables."""

from __future__ import annotations

from ebbsync.config import DEFAULT_NAMESPACES
from workload.queries import LANGS, PASS_LIMITS
from workload.tables import BATCH_ID_STEP

WIKIS = """
wikis AS (
    SELECT n_nationkey AS wiki_id, lower(replace(n_name, '_', '-')) || '.wiki.test' AS domain,
           'qs-' || n_regionkey || '.test:9999' AS backend, 'ns_' || n_nationkey AS namespace
    FROM nation
)"""

CHANGES = """
changes AS (
    SELECT c_nationkey AS wiki_id, o_orderkey AS change_id, o_orderdate AS ts, o_orderstatus AS status,
           c_custkey, 'Q' || c_custkey AS entity_id, c_acctbal, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey
)"""

REQUESTS = f"""{CHANGES},
placed AS (
    SELECT *, row_number() OVER (PARTITION BY wiki_id ORDER BY ts, change_id) - 1 AS pos FROM changes
),
numbered AS (
    SELECT *, CAST(pos // 20 AS BIGINT) AS seq, CAST(pos % 20 AS INTEGER) AS id_pos,
           CAST(wiki_id AS BIGINT) * {BATCH_ID_STEP} + CAST(pos // 20 AS BIGINT) AS batch_id
    FROM placed
),
batches AS (
    SELECT batch_id, wiki_id, seq, string_agg(entity_id, ',' ORDER BY pos) AS entity_ids, count(*) AS n
    FROM numbered GROUP BY ALL
),
feed AS (
    SELECT *, seq AS poll_seq,
           CAST(row_number() OVER (PARTITION BY seq ORDER BY wiki_id) - 1 AS INTEGER) AS batch_pos
    FROM batches
),
requests AS (
    SELECT poll_seq, batch_pos, id_pos, batch_id, f.wiki_id, entity_id, c_custkey, c_mktsegment,
           c_acctbal >= -800 AS fetched
    FROM numbered JOIN feed f USING (batch_id)
),
outcome AS (
    SELECT batch_id, poll_seq, count(*) AS total, count(*) FILTER (NOT fetched) AS failed,
           bool_and(fetched) AS success
    FROM requests GROUP BY ALL
)"""

SIDES = f"""{WIKIS},
facts AS (
    SELECT wiki_id, 'https://' || domain || '/entity/Q' || c_custkey AS s, 'P' || l_linenumber AS p,
           CAST(l_partkey AS VARCHAR) AS o, l_returnflag AS flag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN wikis ON wiki_id = c_nationkey
),
stored AS (SELECT DISTINCT wiki_id, s, p, o FROM facts WHERE flag IN ('A', 'N')),
truth AS (SELECT DISTINCT wiki_id, s, p, o FROM facts WHERE flag IN ('N', 'R'))"""

DIFF = f"""{REQUESTS}, {SIDES},
touched AS (
    SELECT DISTINCT r.wiki_id, 'https://' || domain || '/entity/' || entity_id AS s
    FROM requests r JOIN outcome USING (batch_id) JOIN wikis w ON w.wiki_id = r.wiki_id
    WHERE success
),
inserts AS (
    (SELECT * FROM truth EXCEPT SELECT * FROM stored)
),
deletes AS (
    (SELECT * FROM stored EXCEPT SELECT * FROM truth)
),
ops AS (
    SELECT 'I' AS op, * FROM inserts SEMI JOIN touched USING (wiki_id, s)
    UNION ALL
    SELECT 'D' AS op, * FROM deletes SEMI JOIN touched USING (wiki_id, s)
),
live AS (
    SELECT wiki_id, s, p, o FROM truth SEMI JOIN touched USING (wiki_id, s)
    UNION ALL
    SELECT wiki_id, s, p, o FROM stored ANTI JOIN touched USING (wiki_id, s)
)"""

TYPED_DIFF = f"""{REQUESTS}, {SIDES},
allowed AS (SELECT * FROM requests WHERE c_custkey % 4 <> 3),
good AS (SELECT batch_id FROM feed ANTI JOIN (SELECT batch_id FROM allowed WHERE NOT fetched) USING (batch_id)),
touched AS (
    SELECT DISTINCT a.wiki_id, 'https://' || domain || '/entity/' || entity_id AS s
    FROM allowed a JOIN good USING (batch_id) JOIN wikis w ON w.wiki_id = a.wiki_id
),
live AS (
    SELECT wiki_id, s, p, o FROM truth SEMI JOIN touched USING (wiki_id, s)
    UNION ALL
    SELECT wiki_id, s, p, o FROM stored ANTI JOIN touched USING (wiki_id, s)
)"""

# Every request's entity in the store that its own batch names.
MOVING_DIFF = f"""{REQUESTS}, {SIDES},
allowed AS (SELECT * FROM requests WHERE c_custkey % 4 <> 3),
good AS (SELECT batch_id FROM feed ANTI JOIN (SELECT batch_id FROM allowed WHERE NOT fetched) USING (batch_id)),
touched AS (
    SELECT DISTINCT a.wiki_id, 'https://' || domain || '/entity/' || entity_id AS s, backend,
           CASE WHEN poll_seq % 3 = 1 AND a.wiki_id % 3 < 2 THEN namespace || '_new' ELSE namespace END AS namespace
    FROM allowed a JOIN good USING (batch_id) JOIN wikis w ON w.wiki_id = a.wiki_id
),
live AS (
    SELECT wiki_id, s, p, o, backend, namespace FROM truth JOIN touched USING (wiki_id, s)
    UNION ALL
    SELECT wiki_id, s, p, o, backend, namespace FROM (SELECT * FROM stored JOIN wikis USING (wiki_id))
    ANTI JOIN touched USING (wiki_id, s, backend, namespace)
)"""

# Every entity that any request asks for.
ALL_TOUCHED = f"""{REQUESTS}, {SIDES},
touched AS (
    SELECT DISTINCT r.wiki_id, 'https://' || domain || '/entity/' || entity_id AS s
    FROM requests r JOIN wikis w ON w.wiki_id = r.wiki_id
),
live AS (
    SELECT wiki_id, s, p, o FROM truth SEMI JOIN touched USING (wiki_id, s)
    UNION ALL
    SELECT wiki_id, s, p, o FROM stored ANTI JOIN touched USING (wiki_id, s)
)"""

# The text of an event as a poll, and whether it carries a malformed batch too.
EVENT_POLLS = """
event_polls AS (
    SELECT event_id AS poll_seq,
           CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'not_array' WHEN 'error' THEN 'invalid_json'
                WHEN 'signup' THEN 'empty' ELSE 'ok' END AS poll_class,
           event_type NOT IN ('click', 'view', 'error', 'signup') AS has_batch, value < 50 AS has_bad
    FROM events
)"""

TERMS = """
terms AS (SELECT 'Q' || (doc_id // 4) AS entity_id, lang, doc_id, text FROM documents)"""

_in_langs = ", ".join(f"'{lang}'" for lang in LANGS)
_preference = f"list_position([{_in_langs}], lang)"
_limits = ", ".join(f"({n})" for n in PASS_LIMITS)

ORACLES = {
    "feed_scan": f"""WITH {REQUESTS}
        SELECT poll_seq, 'ok' AS poll_class, count(*) AS batches FROM feed GROUP BY poll_seq""",
    "feed_classify": f"""WITH {EVENT_POLLS}
        SELECT poll_seq, poll_class, CAST(has_batch AS BIGINT) AS good_batches,
               CAST(CASE WHEN has_batch AND has_bad THEN 2 ELSE 0 END AS BIGINT) AS malformed_batches
        FROM event_polls""",
    "feed_quarantine": f"""WITH {EVENT_POLLS}
        SELECT poll_seq, CAST(NULL AS INTEGER) AS batch_pos, poll_class AS reason,
               CASE poll_class WHEN 'empty' THEN '' WHEN 'invalid_json' THEN '{{bad'
                    ELSE '{{"id":' || poll_seq || '}}' END AS payload
        FROM event_polls WHERE poll_class <> 'ok'
        UNION ALL
        SELECT poll_seq, 1, 'malformed_batch', '{{"id":' || poll_seq || '}}'
        FROM event_polls WHERE has_batch AND has_bad
        UNION ALL
        SELECT poll_seq, 2, 'malformed_batch', '5' FROM event_polls WHERE has_batch AND has_bad""",
    "batch_pack": f"""WITH {REQUESTS}
        SELECT batch_id, wiki_id, seq, entity_ids, n FROM batches""",
    "batch_flatten": f"""WITH {REQUESTS}, {WIKIS}
        SELECT poll_seq, batch_pos, batch_id, entity_ids, domain, backend, namespace
        FROM feed JOIN wikis USING (wiki_id)""",
    "target_urls": f"""WITH {REQUESTS}, {WIKIS}
        SELECT batch_id, 'http://' || backend || '/bigdata/namespace/' || namespace || '/sparql' AS sparql_url,
               'https://' || domain AS concept_uri, 'https://' || domain AS wiki_url,
               '{DEFAULT_NAMESPACES}' AS namespaces, domain || '=ingress.test:8080' AS proxy_map
        FROM feed JOIN wikis USING (wiki_id)""",
    "entity_requests": f"""WITH {REQUESTS}
        SELECT poll_seq, batch_pos, id_pos, batch_id, wiki_id, entity_id FROM requests""",
    "namespace_filter": f"""WITH {CHANGES},
        slots(entity_type, ns, slot) AS (VALUES ('item', 120, 'main'), ('property', 122, 'main')),
        typed AS (
            SELECT *, CASE c_custkey % 4 WHEN 0 THEN 'item' WHEN 1 THEN 'item' WHEN 2 THEN 'property'
                           ELSE 'other' END AS entity_type
            FROM changes
        )
        SELECT change_id, wiki_id, entity_id, entity_type, ns, slot FROM typed JOIN slots USING (entity_type)
        WHERE ns IN (120, 122, 146)""",
    "state_lookup": f"""WITH {REQUESTS}
        SELECT batch_id, id_pos, wiki_id, entity_id, CASE WHEN fetched THEN c_mktsegment END AS segment, fetched
        FROM requests""",
    "payload_dump": f"""WITH {REQUESTS}
        SELECT batch_id, id_pos, entity_id, CASE WHEN fetched THEN c_mktsegment END AS segment FROM requests""",
    "batch_outcome": f"""WITH {REQUESTS}
        SELECT batch_id, total, failed, success FROM outcome""",
    "ack_payloads": f"""WITH {REQUESTS}
        SELECT batch_id, CASE WHEN success THEN 'done' ELSE 'not_done' END AS status,
               '{{"batches":[' || batch_id || ']}}' AS body
        FROM outcome""",
    "ack_validate": """
        WITH bodies AS (
            SELECT event_id, CASE event_type WHEN 'click' THEN '{"batches":[' || event_id || ']}'
                   WHEN 'view' THEN '{"batches":[]}' WHEN 'error' THEN '{bad' WHEN 'signup' THEN props
                   ELSE '{"batches":"x"}' END AS body
            FROM events
        ),
        parsed AS (
            SELECT event_id, CASE WHEN json_valid(body) THEN json_extract(body, '$.batches') END AS ids FROM bodies
        ),
        checked AS (
            SELECT event_id, ids,
                   coalesce(json_type(ids) = 'ARRAY' AND json_array_length(ids) > 0, false) AS valid
            FROM parsed
        )
        SELECT event_id, CAST(CASE WHEN valid THEN 200 ELSE 500 END AS INTEGER) AS http_status,
               CASE WHEN valid THEN CAST(json_extract(ids, '$[0]') AS BIGINT) END AS batch_id
        FROM checked""",
    "pending_batches": f"""WITH {REQUESTS}
        SELECT batch_id, poll_seq FROM feed
        EXCEPT SELECT batch_id, poll_seq FROM outcome WHERE success""",
    "sync_inserts": f"WITH {DIFF} SELECT wiki_id, s, p, o FROM ops WHERE op = 'I'",
    "sync_deletes": f"WITH {DIFF} SELECT wiki_id, s, p, o FROM ops WHERE op = 'D'",
    "sync_verify": f"""WITH {DIFF}
        SELECT wiki_id, s, count(*) FILTER (op = 'I') AS missing, count(*) FILTER (op = 'D') AS extra
        FROM ops GROUP BY wiki_id, s""",
    "store_apply": f"""WITH {DIFF}
        SELECT op, backend, namespace, wiki_id, s, p, o FROM ops JOIN wikis USING (wiki_id)""",
    "store_current": f"""WITH {DIFF}
        SELECT wiki_id, s, p, o, backend, namespace FROM live JOIN wikis USING (wiki_id)""",
    "store_compact": f"""WITH {DIFF}
        SELECT 'I' AS op, CAST(1 AS BIGINT) AS epoch, wiki_id, s, p, o FROM live""",
    "munge_lang_filter": f"""WITH {TERMS}
        SELECT entity_id, lang, doc_id, text FROM terms WHERE lang IN ('en', 'de')""",
    "munge_single_label": f"""WITH {TERMS},
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY {_preference}, doc_id) AS place
            FROM terms WHERE lang IN ({_in_langs})
        )
        SELECT entity_id, lang, doc_id, text FROM ranked WHERE place = 1""",
    "munge_facts": f"""WITH {TERMS},
        facts AS (
            SELECT 'term' AS kind, 'label@' || lang AS p, text AS o FROM terms
            UNION ALL
            SELECT 'statement', 'P' || l_linenumber, CAST(l_partkey AS VARCHAR)
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            UNION ALL
            SELECT 'sitelink', 'sitelink', url FROM pages
        ),
        tried AS (
            SELECT false AS skip_links, * FROM facts
            UNION ALL SELECT true, * FROM facts WHERE kind <> 'sitelink'
        )
        SELECT skip_links, kind, p, count(*) AS facts, CAST(sum(length(o)) AS BIGINT) AS chars
        FROM tried GROUP BY ALL""",
    "latest_change": f"""WITH {REQUESTS},
        ranked AS (
            SELECT *, count(*) OVER (PARTITION BY wiki_id, entity_id) - 1 AS superseded,
                   row_number() OVER (PARTITION BY wiki_id, entity_id
                                      ORDER BY poll_seq DESC, batch_pos DESC, id_pos DESC) AS place
            FROM requests
        )
        SELECT wiki_id, entity_id, poll_seq, batch_pos, id_pos, batch_id, superseded FROM ranked WHERE place = 1""",
    "resume_point": f"""WITH {CHANGES},
        starts AS (
            SELECT wiki_id, max(ts) AS last_ts FROM changes WHERE status = 'F' AND wiki_id % 5 <> 0 GROUP BY wiki_id
        ),
        newest AS (SELECT max(ts) - INTERVAL 90 DAYS AS floor_ts FROM changes)
        SELECT wiki_id, change_id, entity_id, ts, coalesce(last_ts, floor_ts) AS start_ts
        FROM changes LEFT JOIN starts USING (wiki_id) CROSS JOIN newest
        WHERE ts >= coalesce(last_ts, floor_ts)""",
    "pass_metrics": f"""WITH {REQUESTS}
        SELECT poll_seq, 'ok' AS poll_class, count(*) AS batches, CAST(0 AS BIGINT) AS malformed,
               count(*) FILTER (success) AS done, count(*) FILTER (NOT success) AS not_done,
               CAST(sum(total) AS BIGINT) AS entities
        FROM outcome GROUP BY poll_seq""",
    "pass_limit": f"""WITH {REQUESTS},
        limits(pass_limit) AS (VALUES {_limits})
        SELECT pass_limit, count(DISTINCT poll_seq) AS polls, count(*) AS batches, max(poll_seq) AS last_poll
        FROM feed JOIN limits ON pass_limit = -1 OR poll_seq < pass_limit
        GROUP BY pass_limit""",
    "run_once_sync": f"""WITH {SIDES},
        good AS (
            SELECT c_nationkey, c_mktsegment FROM customer GROUP BY ALL HAVING bool_and(c_acctbal >= -800)
        ),
        touched AS (
            SELECT wiki_id, 'https://' || domain || '/entity/Q' || c_custkey AS s
            FROM customer JOIN good USING (c_nationkey, c_mktsegment) JOIN wikis ON wiki_id = c_nationkey
        ),
        ops AS (
            SELECT 'I' AS op, * FROM (SELECT * FROM truth EXCEPT SELECT * FROM stored)
            UNION ALL
            SELECT 'D' AS op, * FROM (SELECT * FROM stored EXCEPT SELECT * FROM truth)
        )
        SELECT op, wiki_id, s, p, o FROM ops SEMI JOIN touched USING (wiki_id, s)""",
    "catch_up_sync": f"""WITH {CHANGES}, {SIDES},
        starts AS (
            SELECT wiki_id, max(ts) AS last_ts FROM changes WHERE status = 'F' AND wiki_id % 5 <> 0 GROUP BY wiki_id
        ),
        again AS (
            SELECT changes.*, (row_number() OVER (PARTITION BY wiki_id ORDER BY ts, change_id) - 1) // 20 AS seq
            FROM changes LEFT JOIN starts USING (wiki_id)
            WHERE ts >= coalesce(last_ts, (SELECT max(ts) - INTERVAL 90 DAYS FROM changes))
        ),
        good AS (SELECT wiki_id, seq FROM again GROUP BY ALL HAVING bool_and(c_acctbal >= -800)),
        touched AS (
            SELECT DISTINCT wiki_id, 'https://' || domain || '/entity/' || entity_id AS s
            FROM again JOIN good USING (wiki_id, seq) JOIN wikis USING (wiki_id)
        ),
        ops AS (
            SELECT 'I' AS op, * FROM (SELECT * FROM truth EXCEPT SELECT * FROM stored)
            UNION ALL
            SELECT 'D' AS op, * FROM (SELECT * FROM stored EXCEPT SELECT * FROM truth)
        )
        SELECT op, wiki_id, s, p, o FROM ops SEMI JOIN touched USING (wiki_id, s)""",
    "batch_pack_calls": f"""WITH {REQUESTS}
        SELECT batch_id, wiki_id, seq, entity_ids, n FROM batches""",
    "catch_up_resumed": f"""WITH {ALL_TOUCHED}
        SELECT wiki_id, s, p, o, backend, namespace FROM live JOIN wikis USING (wiki_id)""",
    "store_merge": f"""WITH {DIFF}
        SELECT wiki_id, s, p, o, backend, namespace FROM live JOIN wikis USING (wiki_id)""",
    "stream_update": f"""WITH {TYPED_DIFF}
        SELECT wiki_id, s, p, o, backend, namespace FROM live JOIN wikis USING (wiki_id)""",
    "stream_redelivery": f"""WITH {TYPED_DIFF}
        SELECT wiki_id, s, p, o, backend, namespace FROM live JOIN wikis USING (wiki_id)""",
    "stream_late": f"""WITH {TYPED_DIFF}
        SELECT wiki_id, s, p, o, backend, namespace FROM live JOIN wikis USING (wiki_id)""",
    "stream_moving": f"WITH {MOVING_DIFF} SELECT wiki_id, s, p, o, backend, namespace FROM live",
    "stream_moving_backlog": f"WITH {MOVING_DIFF} SELECT wiki_id, s, p, o, backend, namespace FROM live",
    "delivery_states": f"""WITH {REQUESTS},
        tried AS (
            SELECT poll_seq, batch_pos, bool_and(c_acctbal >= -800) AS first, bool_and(c_acctbal >= -900) AS second
            FROM requests JOIN customer USING (c_custkey) WHERE poll_seq % 7 <> 6 GROUP BY ALL
        )
        SELECT poll_seq, batch_pos, CAST(batch_pos + 1 AS BIGINT) AS batch_id,
               CAST(CASE WHEN first IS NULL THEN 0 WHEN first THEN 1 ELSE 2 END AS BIGINT) AS tries,
               CASE WHEN first IS NULL THEN 'unanswered' WHEN first OR second THEN 'done' ELSE 'given_up' END AS state
        FROM feed LEFT JOIN tried USING (poll_seq, batch_pos)""",
    "stream_requeue": f"""WITH {ALL_TOUCHED}
        SELECT wiki_id, s, p, o, backend, namespace FROM live JOIN wikis USING (wiki_id)""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
}
