"""Fixed schemas of the tables that the updater reads and writes."""

POLL = "poll_seq BIGINT, body STRING"

BATCH = (
    "poll_seq BIGINT, batch_pos INT, batch_id BIGINT, entity_ids STRING, "
    "domain STRING, backend STRING, namespace STRING"
)

# One row per element of a poll, or one row for a poll without elements.
LANDED = BATCH + ", poll_class STRING, batch_class STRING, payload STRING, landed_at TIMESTAMP"

# Backend, namespace and slice are directories, and of single epochs and runs their numbers too.
PLACE = "backend STRING, namespace STRING, slice STRING"

CHANGE_LOG = f"op STRING, wiki_id INT, s STRING, p STRING, o STRING, bucket INT, epoch BIGINT, {PLACE}"

STORE_RUN = f"op STRING, epoch BIGINT, wiki_id INT, s STRING, p STRING, o STRING, bucket INT, run STRING, {PLACE}"

STORE_BASE = f"wiki_id INT, s STRING, p STRING, o STRING, bucket INT, {PLACE}"

ACK = "batch_id BIGINT, poll_seq BIGINT, batch_pos INT, total BIGINT, failed BIGINT, body STRING, epoch BIGINT, status STRING"
