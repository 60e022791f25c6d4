"""Procurement tables derived from the test data, as SQL that Spark and DuckDB both read.

Each entry may use the base tables and the entries before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

TABLES: dict[str, str] = {
    "requisitions": """select concat('R_', cast(o_orderkey as string), '/', cast(year(o_orderdate) as string)) as req_no, o_orderkey,
        o_orderdate as created_on, o_orderpriority as priority_id, o_totalprice from orders""",
    "tracker": """select req_no, cast(o_orderkey % 9 as int) as stage_id,
        case when o_orderkey % 4 = 0 then null else concat('u-', cast(o_orderkey as string)) end as tracker_uuid,
        cast(created_on as date) as created_at, cast(created_on as date) as updated_at from requisitions where o_orderkey % 3 <> 0""",
    "attachments": """select d.doc_id as attachment_id, m.req_no from documents d join requisitions m on m.o_orderkey = d.doc_id % 200""",
    "attachment_documents": """select doc_id as attachment_id, case when doc_id % 7 = 0 then '' else concat('in/', source, '/f', cast(doc_id as string),
        case doc_id % 6 when 0 then '.PDF' when 1 then '.xlsx' when 2 then '.csv' when 3 then '.txt' when 4 then '.zip' else '.png' end) end as attachment_name,
        case when doc_id % 11 = 0 then null else text end as content from documents""",
    "classified": """select a.attachment_id, a.req_no, case a.attachment_id % 6 when 0 then 'Quotation' when 1 then 'RFQ' when 2 then 'MPBC' when 3 then 'BER'
        when 4 then 'E-Auction Results' else 'Others' end as doc_type, cast(a.attachment_id % 4 as double) / 4 as confidence,
        concat('p/', cast(a.attachment_id as string)) as blob_path from attachments a where a.attachment_id % 5 <> 0""",
    "items": """select concat_ws('-', cast(l.l_orderkey as string), cast(l.l_linenumber as string), cast(l.l_partkey as string), cast(l.l_suppkey as string),
        cast(cast(l.l_shipdate as date) as string)) as item_key, l.l_partkey as detail_id, m.req_no, p.p_name as item_name, l.l_quantity as quantity,
        l.l_extendedprice / l.l_quantity as unit_price, l.l_extendedprice as total_price,
        case l.l_partkey % 4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'INR' else null end as currency, s.s_name as supplier_name,
        case when l.l_returnflag = 'A' then 1 else 0 end as is_selected from lineitem l join requisitions m on m.o_orderkey = l.l_orderkey
        join part p on p.p_partkey = l.l_partkey join supplier s on s.s_suppkey = l.l_suppkey""",
    "item_vectors": """select concat('dtl_', cast(vec_id as string)) as id, vec_id as detail_id, label as req_group, embedding as vals from embeddings""",
    "fragments": """select conv_id as doc_id, role as sheet, turn as row_no, text as cell from conversations""",
    "model_response": """select d.doc_id, case doc_id % 10 when 9 then 'not json' when 8 then '[{"pr_no": "R_1"'
        else concat(case when doc_id % 2 = 0 then concat('```json', chr(10)) else '' end,
        '[{"pr_no":"', m.req_no, '","att_id":"', cast(doc_id as string), '","doc_type":"', case when doc_id % 3 = 0 then 'Quotation' else 'RFQ' end, '"',
        case when doc_id % 7 = 0 then '' else concat(',"classification_conf":', cast(doc_id % 4 as string), '.25') end,
        ',"items":[', case when doc_id % 3 = 0 then concat('{"item_name":"', source, '","quantity":', cast(doc_id % 5 as string), ',"unit_price":', cast(n_chars as string), '.5}') else '' end, ']}]',
        case when doc_id % 2 = 0 then concat(chr(10), '```') else '' end) end as raw from documents d join requisitions m on m.o_orderkey = d.doc_id % 200""",
    "label_response": """select doc_id, case doc_id % 6 when 0 then '{"classification":"E-Auction","confidence":0.75}' when 1 then concat('```json', chr(10), '{"classification":"RFQ"}', chr(10), '```')
        when 2 then '{}' when 3 then 'no answer' when 4 then '{"classification":"Other","confidence":0.5}' else '{"classification":"Quotation","confidence":1.0}' end as raw from documents""",
    "sync_control": """select cast(s_suppkey as int) as etl_id, concat('dbo.table_', cast(s_suppkey as string)) as source, concat('stage.table_', cast(s_suppkey as string)) as destination,
        s_nationkey as sync_hours, case when s_suppkey % 3 = 0 then 0 else 1 end as enable_sync from supplier""",
    "table_control": """select cast(pos as int) as etl_id, concat('dbo.', name) as source, name as destination, 24 as sync_hours, case when name = 'events' then 0 else 1 end as enable_sync
        from (values (1, 'region'), (2, 'nation'), (3, 'customer'), (4, 'supplier'), (5, 'part'), (6, 'orders'), (7, 'lineitem'), (8, 'events'), (9, 'missing')) t(pos, name)""",
    "sync_status": """select cast(o_orderkey % 100 as int) as etl_id, o_orderkey as run_id, cast(o_orderdate as date) as synced_on,
        case when o_orderstatus = 'F' then 'FAILED' else 'SUCCESS' end as status, o_custkey as n_rows,
        case when o_orderstatus <> 'F' then null else case o_orderkey % 4 when 0 then 'Connection reset by peer' when 1 then concat('State 08S01', chr(10), 'link failure')
        when 2 then 'Invalid column name' else 'The wait operation TIMED OUT' end end as error_message from orders""",
    "offers": """select o_orderkey as doc_id, concat_ws(chr(10),
        case when o_orderkey % 6 in (0, 4) then concat('Vendor Name: V', cast(o_custkey as string)) end,
        case when o_orderkey % 6 = 0 and o_orderkey % 5 <> 0 then 'Address: 5 High Street' end,
        case when o_orderkey % 6 in (0, 1) then 'Date: 2024-05-01' end,
        case when o_orderkey % 6 = 0 and o_orderkey % 7 <> 0 then concat('Total Amount: ', cast(o_custkey as string)) end,
        case when o_orderkey % 6 = 0 and o_orderkey % 4 <> 0 then 'Payment Terms: 30 days net' end,
        case when o_orderkey % 6 in (0, 3) and o_orderkey % 9 <> 0 then 'Delivery Time: 6 weeks' end,
        case when o_orderkey % 6 = 0 and o_orderkey % 8 <> 0 then 'Validity: 60 days' end,
        case when o_orderkey % 6 = 0 and o_orderkey % 11 <> 0 then concat('Item Description: Bolt M', cast(o_orderkey % 40 as string), ' | Quantity: 4 | Unit Price: ', cast(o_orderkey % 90 as string), '.5 | Currency: EUR') end,
        case when o_orderkey % 6 = 1 then 'RFQ Number: 77' end, case when o_orderkey % 6 = 1 and o_orderkey % 4 <> 0 then 'Project Name: Line 4' end,
        case when o_orderkey % 6 = 1 and o_orderkey % 5 <> 0 then 'Specification | Supplier to specify' end, case when o_orderkey % 6 = 1 and o_orderkey % 7 <> 0 then 'Commercials' end,
        case when o_orderkey % 6 = 2 and o_orderkey % 5 <> 0 then 'BID EXCEPTION REPORT' end, case when o_orderkey % 6 = 2 then 'Order Value: 12' end,
        case when o_orderkey % 6 = 2 then 'Justification: sole source' end, case when o_orderkey % 6 = 2 and o_orderkey % 4 <> 0 then 'A) urgent B) single source' end,
        case when o_orderkey % 6 = 2 and o_orderkey % 7 <> 0 then 'Prepared by / Purchasing / MD' end,
        case when o_orderkey % 6 = 3 then 'Event ID: 5' end, case when o_orderkey % 6 = 3 then 'BID Id: 8' end, case when o_orderkey % 6 = 3 and o_orderkey % 5 <> 0 then 'Participant: V2, 10:45' end,
        case when o_orderkey % 6 = 3 and o_orderkey % 4 <> 0 then 'Reverse Auction' end, case when o_orderkey % 6 = 3 and o_orderkey % 7 <> 0 then 'Basic Price 5 Extended Price 50' end,
        case when o_orderkey % 6 = 4 then 'Supplier 1 | Supplier 2' end, case when o_orderkey % 6 = 4 and o_orderkey % 5 <> 0 then 'Supplier 3' end,
        case when o_orderkey % 6 = 4 and o_orderkey % 7 <> 0 then 'Bid comparison, approved' end, case when o_orderkey % 6 = 4 and o_orderkey % 4 <> 0 then 'RAS No 4, GSP' end,
        o_orderpriority) as text from orders""",
    "run_attachments": """select attachment_id, req_no from attachments union all select -1 - o_orderkey as attachment_id, req_no from requisitions""",
    "run_documents": """select attachment_id, attachment_name, content from attachment_documents
        union all select -1 - doc_id as attachment_id, concat('in/offers/f', cast(doc_id as string), '.txt') as attachment_name, text as content from offers""",
    "run_stats": """select attachment_id, cast(attachment_id % 3 as int) as n_pages, cast(attachment_id * 7 % 1200 as int) as width, cast(attachment_id * 5 % 900 as int) as height,
        case when attachment_id % 13 = 0 then null else cast(attachment_id % 100 as double) / 100 end as bright_frac from run_attachments where attachment_id >= 0""",
    "run_items": """select item_key, case when quantity = 7 and detail_id % 10 = 0 then null else detail_id end as detail_id, req_no, item_name, quantity, unit_price, total_price, currency, supplier_name, is_selected from items""",
    "run_classified": """select attachment_id, req_no, case when attachment_id % 2 = 0 then null else 'u-old' end as tracker_uuid, concat('p/', cast(attachment_id as string)) as blob_path, 'RFQ' as doc_type,
        cast(0.5 as double) as confidence, cast('2023-01-01' as date) as created_at, cast('2023-01-01' as date) as updated_at from run_attachments where attachment_id % 5 = 0""",
    "benchmarks": """select p_partkey as detail_id, 'USD' as currency, p_retailprice as bp_unit_price, 'old' as summary, cast('2023-01-01' as date) as created_at, cast('2023-01-01' as date) as updated_at from part where p_partkey % 2 = 0""",
    "image_stats": """select page_id as file_id, cast(page_id % 1200 as int) as width, cast(page_id * 7 % 900 as int) as height,
        case when page_id % 13 = 0 then null else cast(page_id % 100 as double) / 100 end as bright_frac from pages""",
}


def with_clause(*names: str) -> str:
    """``WITH ...`` that defines the named tables and those they are made from; empty without names."""
    wanted: set[str] = set()
    for name in reversed(TABLES):
        if name in names or any(name in TABLES[w].replace("(", " ").split() for w in wanted):
            wanted.add(name)
    return "WITH " + ", ".join(f"{n} AS ({TABLES[n]})" for n in TABLES if n in wanted) if wanted else ""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base or derived table as a DataFrame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    body = with_clause(name)
    base = ", ".join(f"{b} AS (SELECT * FROM parquet.`{sf_dir}/{b}.parquet`)" for b in BASE if f" {b}" in body)
    return spark.sql(f"WITH {', '.join(filter(None, (base, body.removeprefix('WITH '))))} SELECT * FROM {name}")
