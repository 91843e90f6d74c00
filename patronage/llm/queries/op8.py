"""All pages written to WARC archives, read back and assembled to captures."""

from patronage.llm import warc
from patronage.llm.queries import table
from patronage.session import cut_lineage, scratch_path

NAME = "op8_warc"
SQL = """
WITH payloads AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
typed AS (
    SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
        min(page_id) OVER (PARTITION BY html) AS first_id,
        row_number() OVER (PARTITION BY html ORDER BY page_id, url) AS place FROM payloads),
bits AS (
    SELECT *, array_to_string([
        substr('0000000100100011010001010110011110001001101010111100110111101111',
            4 * strpos('0123456789abcdef', substr(hex, i, 1)) - 3, 4) for i in range(1, 41)], '') AS bits FROM typed)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
            + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT
            + substr(bits, 5 * i + 5, 1)::INT, 1) for i in range(0, 32)], '') AS payload_digest,
    CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN place > 1 THEN first_id END AS refers_to
FROM bits
"""


def query(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    # only digests of the payloads are returned, so the records are kept without them
    records = cut_lineage(warc.read(spark, path, with_payload=False))
    return warc.pages(warc.captures(records))
