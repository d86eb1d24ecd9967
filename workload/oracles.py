"""The same results as plain SQL over the same tables, for a second engine."""

from __future__ import annotations

TXN = """
txn as (
  select o_orderkey as txn_id, o_custkey as acct_no, cast(o_orderdate as date) as txn_date,
         o_totalprice as amount, o_orderstatus as status,
         nullif(o_orderpriority, '5-LOW') as priority
  from orders
)"""

TEXT_TXN = """
text_txn as (
  select cast(o_orderkey as varchar) as txn_id,
         case when o_orderstatus = 'P' then 'n/a'
              else strftime(o_orderdate, '%d/%m/%Y') end as txn_day,
         case when o_orderpriority = '1-URGENT' then 'n/a'
              else strftime(o_orderdate, '%Y-%m-%d') end as txn_iso,
         case when o_orderpriority = '1-URGENT' then 'free'
              else cast(cast(o_totalprice as decimal(12,2)) as varchar) end as amount,
         o_orderpriority as priority
  from orders
)"""

MERGE = """
history as (
  select o_orderkey as transaction_id, o_totalprice as amount, o_orderstatus as transaction_type,
         '2020-01-01' as effective_start_date, '9999-12-31' as effective_end_date,
         true as is_current
  from orders
  union all
  select o_orderkey, o_totalprice - 1, o_orderstatus, '2019-01-01', '2020-01-01', false
  from orders
),
business as (
  select transaction_id, amount, transaction_type from history where is_current
),
batch as (
  select case when o_orderpriority = '5-LOW' then -1 - o_orderkey else o_orderkey end
           as transaction_id,
         case when o_orderstatus = 'P' then o_totalprice + 1
              when o_orderpriority = '1-URGENT' then cast(null as double)
              else o_totalprice end as amount,
         o_orderstatus as transaction_type
  from orders
)"""

# First failed rule of every transaction, NULL for a valid one.
TAGGED = (
    TXN
    + """,
tagged as (
  select *, case
      when priority is null then 'priority null'
      when not regexp_matches(priority, '^[1-4]-') then 'priority regex'
      when not coalesce(amount >= 5000 and amount <= 450000, false) then 'amount outside range'
      when not coalesce(status in ('O', 'F'), false) then 'status invalid value'
    end as error_reason
  from txn
)"""
)

TXN_TEXT_COLUMNS = (
    "txn_id, acct_no, cast(txn_date as varchar) as txn_date, amount, status, priority"
)

LATEST_LINES = """
lines as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount + 0.0 as l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  from lineitem
),
latest as (
  select * exclude (rn) from (
    select *, row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn
    from lines)
  where rn = 1
),
checked as (
  select l_orderkey as order_id, l_partkey, l_suppkey, l_linenumber as line_no, l_quantity,
         cast(cast(l_extendedprice as decimal(12,2)) as varchar) as price,
         l_discount, l_tax, l_returnflag as return_flag, l_linestatus as line_status, l_shipdate,
         case when l_orderkey is null then 'order_id null'
              when l_linenumber is null then 'line_no null'
              when not regexp_matches(l_returnflag, '[AR]') then 'return_flag regex'
              when not regexp_matches(l_linestatus, '[OF]') then 'line_status regex'
         end as error_reason
  from latest
)"""

CAPPED = (
    TXN
    + """,
capped as (
  select txn_id, acct_no, txn_date, status, priority,
         case when amount <= 400000 then amount end as amount
  from txn
)"""
)

CHANGED = """
changed as (
  select h.* from history h join batch b on h.transaction_id = b.transaction_id
  where h.is_current
    and (h.amount is distinct from b.amount
         or h.transaction_type is distinct from b.transaction_type)
),
changed_as_read as (
  select h.* from history h join batch b on h.transaction_id = b.transaction_id
  where h.amount <> b.amount or h.transaction_type <> b.transaction_type
),
fresh as (
  select b.transaction_id, b.amount, b.transaction_type,
         '2025-11-14' as effective_start_date, '9999-12-31' as effective_end_date,
         true as is_current
  from batch b left join history h on h.transaction_id = b.transaction_id and h.is_current
  where h.transaction_id is null
     or h.amount is distinct from b.amount
     or h.transaction_type is distinct from b.transaction_type
)"""

CLOSED_COLUMNS = """transaction_id, amount, transaction_type, effective_start_date,
    '2025-11-14' as effective_end_date, false as is_current"""

SCD2_STRICT = f"""with {MERGE}, {CHANGED}
select * from history h
where not h.is_current
   or not exists (select 1 from changed c where c.transaction_id = h.transaction_id)
union all select {CLOSED_COLUMNS} from changed
union all select * from fresh"""

# Valid rows of a load: amounts within limits, after mapping.
LOADED = (
    MERGE
    + """,
first_valid as (
  select * from business where coalesce(amount >= 5000 and amount <= 450000, false)
),
second_valid as (
  select * from batch where coalesce(amount >= 5000 and amount <= 450000, false)
)"""
)


def _scd2_load(first_date: str, second_date: str, note: bool = False) -> str:
    old, new = (", 'n' || transaction_id as note", ", null as note") if note else ("", "")
    return f"""with {LOADED},
pairs as (
  select coalesce(f.transaction_id, s.transaction_id) as transaction_id,
         f.amount as old_amount, f.transaction_type as old_type,
         s.amount as new_amount, s.transaction_type as new_type,
         f.transaction_id is not null as in_first, s.transaction_id is not null as in_second,
         f.amount is distinct from s.amount
           or f.transaction_type is distinct from s.transaction_type as differs
  from first_valid f full join second_valid s on f.transaction_id = s.transaction_id
)
select transaction_id, old_amount as amount, old_type as transaction_type,
       '{first_date}' as effective_start_date,
       case when in_second and differs then '{second_date}' else '9999-12-31' end
         as effective_end_date,
       not (in_second and differs) as is_current{old}
from pairs where in_first
union all
select transaction_id, new_amount, new_type, '{second_date}', '9999-12-31', true{new}
from pairs where in_second and (not in_first or differs)"""


def _profile(table: str, columns: list[tuple[str, str]]) -> str:
    """One row per column over a table expression: name and count expression."""
    parts = [
        f"select '{name}' as column_name, count(*) as total_rows, {count} from {table}"
        for name, count in columns
    ]
    return "\nunion all ".join(parts)


_ORDER_TYPES = [
    ("txn_id", "bigint"),
    ("acct_no", "bigint"),
    ("txn_date", "date"),
    ("amount", "double"),
    ("status", "string"),
    ("priority", "string"),
]
_LINE_TYPES = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]


def _contract_fields() -> str:
    return f"with {TXN}\n" + "\nunion all ".join(
        f"select {i} as position, '{n}' as source, '{n}' as target, '{t}' as source_type, "
        f"'{t}' as target_type, count(*) > count({n}) as nullable, "
        f"'Business definition for {n}' as comment from txn"
        for i, (n, t) in enumerate(_ORDER_TYPES)
    )


def _generated_contracts() -> str:
    parts = []
    words = {"ds": "definition", "ds_bare": "definition", "dataset": "description"}
    for dialect, word in words.items():
        for n, t in _LINE_TYPES:
            parts.append(
                f"select '{dialect}' as dialect, '{n}' as source, '{n}' as target, "
                f"'{t}' as source_type, '{t}' as target_type, count(*) > count({n}) as nullable, "
                f"'Business {word} for {n}' as comment from lineitem"
            )
    return "\nunion all ".join(parts)


def _schema_profile() -> str:
    columns = [
        ("transaction_id", "bigint", "txn_id"),
        ("account_number", "string", "acct_no"),
        ("transaction_date", "date", "txn_date"),
        ("amount", "decimal(12,2)", "amount"),
        ("status", "string", "status"),
        ("priority", "string", "priority"),
        ("transaction_type", "string", "null"),
    ]
    parts = []
    for i, (name, type_name, source) in enumerate(columns):
        precision, scale = ("12", "2") if "decimal" in type_name else ("null", "null")
        parts.append(
            f"select {i} as position, '{name}' as name, '{type_name}' as type, "
            f"cast({precision} as integer) as precision, cast({scale} as integer) as scale, "
            f"true as nullable, 'Column {name} description' as description, "
            f"'s3_source' as source, 'curated_layer' as target, "
            f"count(*) - count({source}) as null_rows from txn"
        )
    return f"with {TXN}\n" + "\nunion all ".join(parts)


def _schema_annotated() -> str:
    array = '{"containsNull": true, "elementType": "float", "type": "array"}'
    shown = "{'type': 'array', 'elementType': 'float', 'containsNull': True}"
    columns = [
        ("vec_id", "long", "long"),
        ("embedding", array, shown),
        ("label", "integer", "integer"),
    ]
    return "\nunion all ".join(
        f"select '{n}' as name, '{t}' as type_json, true as nullable, "
        f"'Column {n} of type {d.replace(chr(39), chr(39) * 2)}' as description, "
        f"'{n}' as source, '{n}' as target, count({n}) as value_rows from embeddings"
        for n, t, d in columns
    )


def _as_text(table: str, columns: list[str]) -> str:
    return (
        "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in columns) + f" from {table}"
    )


_PLAIN_REJECT = f"{TXN_TEXT_COLUMNS}, error_reason"

ORACLES: dict[str, str] = {
    # sources
    "scan_parquet": f"with {LATEST_LINES} select * from lines",
    "scan_csv_header": _as_text(
        "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    ),
    "scan_by_contract": _as_text(
        "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    ),
    "contract_fields_table": _contract_fields(),
    "contract_jsonl_parse": """
select 'value' as source_field, 'value' as target_field, 'type_modified' as change_type,
       'double' as target_type, min(value) as minimum, max(value) as maximum,
       cast(null as varchar) as allowed_values from events
union all
select 'event_type', 'kind', 'renamed', null, null, null,
       min(event_type) || ',' || max(event_type) from events
union all
select 'props', 'payload', null, null, null, null, null from events
  having count(*) > 0""",
    "read_or_empty": "select * from customer",
    # sinks
    "sink_overwrite_roundtrip": "select * from part",
    "sink_dynamic_partition": """
with dated as (
  select event_id, user_id, value, strftime(ts, '%Y-%m-%d') as dt from events
)
select event_id, user_id, dt,
       case when dt = (select max(dt) from dated) then value + 1 else value end as value
from dated""",
    "sink_raw_copy": "select *, '2025-11-14' as dt, '08' as hr from customer",
    "sink_append_rejects": f"""with {TAGGED},
rejects as (
  select {_PLAIN_REJECT}, '2025-11-14' as dt, '08' as hr from tagged
  where error_reason is not null
)
select * from rejects union all select * from rejects""",
    "sink_append_retry": f"""with {TAGGED}
select {_PLAIN_REJECT}, '2025-11-14' as dt, '08' as hr,
       case when txn_id % 2 = 0 then 'first' else 'second' end as batch
from tagged where error_reason is not null""",
    "sink_overwrite_own_input": f"""with {TXN}
select txn_id, acct_no, txn_date, amount * 2 as amount, status, priority from txn where amount >= 5000""",
    "table_two_batches_at_once": f"""with {MERGE},
late as (select transaction_id, amount + 100 as amount, transaction_type from batch),
first as (
  select b.*, '2025-11-12' as effective_start_date, n.transaction_id is not null
      and (b.amount is distinct from n.amount or b.transaction_type is distinct from n.transaction_type) as gone
  from business b left join batch n using (transaction_id)
),
second as (
  select transaction_id, amount, transaction_type, effective_start_date from first where not gone
  union all
  select n.*, '2025-11-13' from batch n
  where not exists (select 1 from first f where f.transaction_id = n.transaction_id and not f.gone)
),
third as (
  select s.*, l.transaction_id is not null
      and (s.amount is distinct from l.amount or s.transaction_type is distinct from l.transaction_type) as gone
  from second s left join late l using (transaction_id)
)
select transaction_id, amount, transaction_type, effective_start_date,
       '2025-11-13' as effective_end_date, false as is_current from first where gone
union all
select transaction_id, amount, transaction_type, effective_start_date,
       case when gone then '2025-11-14' else '9999-12-31' end, not gone from third
union all
select l.*, '2025-11-14', '9999-12-31', true from late l
where not exists (select 1 from third t where t.transaction_id = l.transaction_id and not t.gone)""",
    "table_folded_key_range": f"""with {MERGE},
pairs as (
  select n.transaction_id, n.amount, n.transaction_type,
         b.transaction_id is not null and b.amount is not distinct from n.amount
           and b.transaction_type is not distinct from n.transaction_type as same
  from batch n left join business b using (transaction_id)
)
select transaction_id, amount, transaction_type,
       case when same then '2025-11-11' else '2025-11-12' end as effective_start_date,
       '9999-12-31' as effective_end_date, true as is_current
from pairs where transaction_id between 1000 and 3000""",
    "sink_snapshot_swap": f"""with {MERGE}
select * from batch
union all
select * from business b
where not exists (select 1 from batch n where n.transaction_id = b.transaction_id)""",
    # schema and contracts
    "schema_profile": _schema_profile(),
    "schema_annotated": _schema_annotated(),
    "contract_generate": _generated_contracts(),
    "schema_diff": """
select 'O_ORDERSTATUS' as column_name, 'missing' as status, cast(0 as bigint) as value_rows
union all select 'o_clerk', 'missing', 0
union all select 'o_orderstatus', 'extra', count(o_orderstatus) from orders
union all select 'o_totalprice', 'extra', count(o_totalprice) from orders
union all select 'o_orderdate', 'extra', count(o_orderdate) from orders
union all select 'o_orderpriority', 'extra', count(o_orderpriority) from orders""",
    "schema_policy": """
select o_orderkey, false as schema_ok, 'O_ORDERSTATUS,o_clerk' as missing_columns,
       'o_orderdate,o_orderpriority,o_orderstatus,o_totalprice' as extra_columns
from orders""",
    # mapping
    "map_rename": """
select l_orderkey, l_linenumber, l_partkey as l_suppkey, l_suppkey as l_partkey,
       l_quantity as quantity
from lineitem""",
    "map_cast": """
select cast(o_orderkey as varchar) as o_orderkey, try_cast(o_custkey as integer) as o_custkey,
       o_orderstatus, cast(cast(o_totalprice as decimal(12,2)) as varchar) as o_totalprice,
       cast(cast(o_orderdate as date) as varchar) as o_orderdate,
       try_cast(o_orderpriority as double) as o_orderpriority
from orders""",
    "map_cast_family": f"""with {TEXT_TXN}
select try_cast(txn_id as bigint) as txn_id,
       cast(cast(try_strptime(txn_day, '%d/%m/%Y') as date) as varchar) as txn_day,
       cast(try_cast(txn_iso as date) as varchar) as txn_iso,
       cast(try_cast(amount as decimal(12,2)) as varchar) as amount, priority
from text_txn""",
    "map_cast_lenient": f"""with {TXN}
select cast(txn_id as varchar) as id, acct_no, cast(txn_date as varchar) as day,
       cast(amount as varchar) as amount, try_cast(status as integer) as status
from txn""",
    "parse_date_format": f"""with {TEXT_TXN}
select txn_id, cast(cast(try_strptime(txn_day, '%d/%m/%Y') as date) as varchar) as by_format,
       cast(try_cast(txn_iso as date) as varchar) as by_default
from text_txn""",
    "map_add_column": """
select *, cast(null as varchar) as reviewed_on, o_totalprice > 250000 as is_large from orders""",
    "map_typed_projection": f"""with {TXN}
select txn_id as transaction_id, cast(acct_no as varchar) as account_number,
       cast(txn_date as varchar) as transaction_date,
       cast(cast(amount as decimal(12,2)) as varchar) as amount,
       cast(null as varchar) as transaction_type
from txn""",
    # quality
    "dq_not_null": f"""with {TXN}
select {TXN_TEXT_COLUMNS}, 'priority null' as error_reason from txn where priority is null""",
    "dq_not_null_nan": f"""with {TXN}
select txn_id, status, 'amount null' as error_reason from txn
where status = 'P' or priority is null""",
    "dq_regex": """
select *, 'p_brand regex' as error_reason from part
where not coalesce(regexp_matches(p_brand, '#1[0-9]'), false)""",
    "dq_range": f"""with {CAPPED}
select {_PLAIN_REJECT.replace(", error_reason", "")}, 'amount outside range' as error_reason
from capped where amount < 5000 or amount > 300000""",
    "dq_range_null_rejected": f"""with {CAPPED}
select {_PLAIN_REJECT.replace(", error_reason", "")}, 'amount outside range' as error_reason
from capped where amount is null or amount < 5000 or amount > 300000""",
    "dq_range_null_passed": f"""with {CAPPED}
select {TXN_TEXT_COLUMNS} from capped
where amount is null or (amount >= 5000 and amount <= 300000)""",
    "dq_bound_one_sided": """
select *, 'c_acctbal outside range' as error_reason from customer
where not coalesce(c_acctbal >= 0, false)""",
    "dq_allowed_values": f"""with {TXN}
select {TXN_TEXT_COLUMNS}, 'status invalid value' as error_reason from txn
where status not in ('O', 'F')""",
    "reject_first_failure": f"""with {TAGGED}
select {_PLAIN_REJECT} from tagged where error_reason is not null""",
    "reject_all_reasons": f"""with {TAGGED}
select txn_id, error_reason, concat_ws(',',
    case when priority is null then 'priority null' end,
    case when not coalesce(regexp_matches(priority, '^[1-4]-'), false) then 'priority regex' end,
    case when amount < 5000 or amount > 450000 then 'amount outside range' end,
    case when status not in ('O', 'F') then 'status invalid value' end) as error_reasons
from tagged where error_reason is not null""",
    "valid_rows": f"""with {TAGGED}
select {TXN_TEXT_COLUMNS} from tagged where error_reason is null""",
    "reject_untagged": f"""with {TAGGED}
select {TXN_TEXT_COLUMNS} from tagged where error_reason is not null""",
    "reject_empty": f"""with {TXN},
rejects as (select count(*) as reject_rows from txn where not coalesce(amount >= 0, false))
select column_name, reject_rows from (
  values ('txn_id'), ('acct_no'), ('txn_date'), ('amount'), ('status'), ('priority'),
         ('error_reason')) as names(column_name), rejects""",
    "reject_distinct": """
select distinct l_returnflag, l_linestatus, l_quantity,
       'l_returnflag invalid value' as error_reason
from lineitem where not coalesce(l_returnflag in ('A', 'R'), false)""",
    # counts and gates
    "dq_invalid_all": f"""with {TXN}
select count(*) as total_rows,
       count(*) filter (where status not in ('O', 'F') and amount < 5000) as invalid_rows
from txn""",
    "dq_invalid_any": f"""with {TXN}
select count(*) as total_rows,
       count(*) filter (where status not in ('O', 'F') or amount < 5000) as invalid_rows
from txn""",
    "profile_nulls": f"with {TXN}\n"
    + _profile("txn", [(n, f"count(*) - count({n}) as null_rows") for n, _ in _ORDER_TYPES]),
    "profile_nulls_footers": f"with {TXN}\n"
    + _profile("txn", [(n, f"count(*) - count({n}) as null_rows") for n, _ in _ORDER_TYPES]),
    "profile_regex": f"with {TXN}\n"
    + _profile(
        "txn",
        [
            (n, f"count(*) filter (where not regexp_matches({n}, '{rx}')) as failed_rows")
            for n, rx in (("priority", "^[12]-"), ("status", "[OF]"))
        ],
    ),
    "rowcount_reconcile": f"""with {TXN},
counts as (
  select count(*) as source_rows,
         count(*) filter (where status in ('O', 'F')) as curated_rows from txn
)
select source_rows, curated_rows, source_rows - curated_rows as rejected_rows,
       source_rows <> curated_rows as mismatch,
       case when source_rows > 0
            then round((source_rows - curated_rows) * cast(100.0 as double) / source_rows, 2)
            else 0.0 end as pct_loss
from counts""",
    "gate_valid_ratio": f"""with {TAGGED},
counts as (
  select count(*) as total_rows, count(*) filter (where error_reason is null) as n from tagged
)
select total_rows, round(cast(n as double) / total_rows, 6) as value,
       cast(0.95 as double) as threshold, cast(n as double) / total_rows >= 0.95 as passed
from counts""",
    "gate_reject_pct": f"""with {TXN},
counts as (
  select count(*) as total_rows,
         count(*) filter (where status not in ('O', 'F') or amount < 5000) as n from txn
)
select total_rows, round(cast(n as double) / greatest(total_rows, 1), 6) as value,
       cast(0.05 as double) as threshold,
       cast(n as double) / greatest(total_rows, 1) <= 0.05 as passed
from counts""",
    "gate_null_pct": f"""with {TXN},
counts as (
  select count(*) as total_rows,
         3 * count(*) - count(txn_id) - count(amount) - count(priority) as n from txn
)
select total_rows, round(cast(n as double) / greatest(total_rows, 1), 6) as value,
       cast(0.10 as double) as threshold,
       cast(n as double) / greatest(total_rows, 1) <= 0.10 as passed
from counts""",
    # dedupe
    "dedupe_latest": f"with {LATEST_LINES} select * from latest",
    "dedupe_latest_in_files": f"with {LATEST_LINES} select * from latest",
    "dedupe_hot_key": """
select * exclude (rn) from (
  select *, row_number() over (partition by event_type order by ts desc, event_id desc) as rn
  from events)
where rn = 1""",
    "dedupe_null_keys_collapse": """
select * exclude (rn) from (
  select *, row_number() over (partition by member order by ts desc, event_id desc) as rn
  from (select event_id, ts, case when event_type <> 'view' then user_id end as member, value
        from events))
where rn = 1""",
    "dedupe_null_keys_keep": """
select * exclude (rn) from (
  select *, row_number() over (partition by member order by ts desc, event_id desc) as rn
  from (select event_id, ts, case when event_type <> 'view' then user_id end as member, value
        from events))
where rn = 1 or member is null""",
    "dedupe_missing_upd": """
select * exclude (rn) from (
  select *, row_number() over (
      partition by o_custkey order by o_totalprice desc, o_orderkey desc) as rn
  from orders)
where rn = 1""",
    "dedupe_skip": "select * from orders",
    # merges
    "merge_left_join": f"""with {MERGE}
select n.transaction_id, n.amount, n.transaction_type,
       b.transaction_id as business_transaction_id, b.amount as business_amount,
       b.transaction_type as business_transaction_type
from batch n left join business b on n.transaction_id = b.transaction_id""",
    "merge_updates": f"""with {MERGE}
select * from batch n
where exists (select 1 from business b where b.transaction_id = n.transaction_id)""",
    "merge_inserts": f"""with {MERGE}
select * from batch n
where not exists (select 1 from business b where b.transaction_id = n.transaction_id)""",
    "merge_untouched": f"""with {MERGE}
select * from business b
where not exists (select 1 from batch n where n.transaction_id = b.transaction_id)""",
    "scd1_merge": f"""with {MERGE}
select * from batch
union all
select * from business b
where not exists (select 1 from batch n where n.transaction_id = b.transaction_id)""",
    "scd2_changed": f"with {MERGE}, {CHANGED} select * from changed",
    "scd2_changed_as_read": f"with {MERGE}, {CHANGED} select * from changed_as_read",
    "scd2_close_history": f"with {MERGE}, {CHANGED} select {CLOSED_COLUMNS} from changed",
    "scd2_close_history_repeated": f"""with {MERGE},
greatest_batch as (select transaction_id, amount + 5 as amount, transaction_type from batch)
select h.transaction_id, h.amount, h.transaction_type, h.effective_start_date,
       '2025-11-14' as effective_end_date, false as is_current
from history h join greatest_batch b on h.transaction_id = b.transaction_id
where h.is_current and (h.amount is distinct from b.amount
                        or h.transaction_type is distinct from b.transaction_type)""",
    "scd2_new_versions": f"with {MERGE}, {CHANGED} select * from fresh",
    "scd2_carry_forward": f"""with {MERGE}
select * from history h
where not exists (select 1 from batch n where n.transaction_id = h.transaction_id)""",
    "scd2_merge": SCD2_STRICT,
    "scd2_merge_shuffled": SCD2_STRICT,
    "scd2_merge_looked_up": SCD2_STRICT,
    "scd2_merge_as_read": f"""with {MERGE}, {CHANGED}
select * from history h
where not exists (select 1 from batch n where n.transaction_id = h.transaction_id)
union all select {CLOSED_COLUMNS} from changed_as_read
union all
select *, '2025-11-14', '9999-12-31', true from batch""",
    # loads
    "layer_curated": f"""with {TXN}
select txn_id as transaction_id, cast(acct_no as varchar) as account_number,
       cast(txn_date as varchar) as transaction_date,
       cast(cast(amount as decimal(12,2)) as varchar) as amount, status, priority,
       cast(null as varchar) as transaction_type, '2025-11-14' as dt, '08' as hr,
       epoch_us(timestamp '2025-11-14 08:30:00') as ingest_us
from txn where cast(amount as decimal(12,2)) between 5000 and 450000""",
    "load_hourly": _scd2_load("2025-11-14", "2025-11-14"),
    "load_hourly_column_gone": _scd2_load("2025-11-14", "2025-11-14", note=True),
    "load_hourly_compacted": _scd2_load("2025-11-14", "2025-11-14"),
    "load_hourly_from_lines": _scd2_load("2025-11-14", "2025-11-14"),
    "load_accounts": f"""with {MERGE}, {LATEST_LINES},
source as (
  select * from batch
  union all select transaction_id, amount + 2, transaction_type from batch
  where transaction_type = 'P'
  union all select null, amount, transaction_type from batch where transaction_type = 'F'
),
judged as (
  select transaction_id,
         transaction_id is not null and coalesce(amount between 5000 and 450000, false) as ok
  from source
)
select 'hourly' as load, count(*) as source_rows,
       count(distinct transaction_id) filter (ok) as kept_rows,
       count(*) filter (not ok) as rejected_rows,
       count(*) filter (ok) - count(distinct transaction_id) filter (ok) as duplicate_rows
from judged
union all
select 'strict', (select count(*) from lineitem), count(*) filter (error_reason is null),
       count(*) filter (error_reason is not null), (select count(*) from lineitem) - count(*)
from checked""",
    "load_daily": _scd2_load("2025-11-13", "2025-11-14"),
    "load_daily_rejects": f"""with {MERGE}
select *, 'amount outside range' as error_reason, '2025-11-14' as dt from batch
where not coalesce(amount >= 5000 and amount <= 450000, false)""",
    "load_overwriting": f"""with {MERGE}
select * from batch
union all
select * from business b
where not exists (select 1 from batch n where n.transaction_id = b.transaction_id)""",
    "load_overwriting_column_gone": f"""with {MERGE}
select *, null as note from batch
union all
select *, 'n' || transaction_id from business b
where not exists (select 1 from batch n where n.transaction_id = b.transaction_id)""",
    "load_strict_from_document": f"""with {LATEST_LINES}
select * exclude (error_reason) from checked where error_reason is null""",
    "load_strict_curated": f"""with {LATEST_LINES}
select * exclude (error_reason) from checked where error_reason is null""",
    "load_strict_rejects": f"""with {LATEST_LINES}
select * from checked where error_reason is not null""",
    "load_lenient_counts": f"""with {TEXT_TXN}
select 'null_check.txn_id' as measure, count(*) filter (where txn_id is null) as counted_rows
from text_txn
union all
select 'null_check.txn_date', count(*) filter (where try_strptime(txn_day, '%d/%m/%Y') is null)
from text_txn
union all
select 'null_check.amount', count(*) filter (where try_cast(amount as decimal(12,2)) is null)
from text_txn
union all
select 'null_check.priority', count(*) filter (where priority is null) from text_txn
union all
select 'regex_check.priority', count(*) filter (where not regexp_matches(priority, '^[1-3]-'))
from text_txn
union all
select 'kept', count(*) from text_txn""",
    "load_lenient_rows": f"""with {TEXT_TXN}
select cast(txn_id as bigint) as txn_id,
       cast(cast(try_strptime(txn_day, '%d/%m/%Y') as date) as varchar) as txn_date, txn_iso,
       cast(try_cast(amount as decimal(12,2)) as varchar) as amount, priority
from text_txn""",
    "load_policy_curated": f"""with {TEXT_TXN}
select cast(txn_id as bigint) as txn_id,
       cast(cast(try_strptime(txn_day, '%d/%m/%Y') as date) as varchar) as txn_date, txn_iso,
       cast(try_cast(amount as decimal(12,2)) as varchar) as amount, priority
from text_txn
where try_strptime(txn_day, '%d/%m/%Y') is not null and regexp_matches(priority, '^[1-3]-')""",
    "load_policy_rejects": f"""with {TEXT_TXN}
select distinct cast(txn_id as bigint) as txn_id,
       cast(cast(try_strptime(txn_day, '%d/%m/%Y') as date) as varchar) as txn_date, txn_iso,
       cast(try_cast(amount as decimal(12,2)) as varchar) as amount, priority,
       case when try_strptime(txn_day, '%d/%m/%Y') is null then 'txn_date null'
            else 'priority regex' end as error_reason
from text_txn
where try_strptime(txn_day, '%d/%m/%Y') is null or not regexp_matches(priority, '^[1-3]-')""",
    "load_policy_rerun_rejects": f"""with {TEXT_TXN},
rejects as (
  select distinct cast(txn_id as bigint) as txn_id, txn_day, txn_iso, amount, priority
  from text_txn
  where try_strptime(txn_day, '%d/%m/%Y') is null or not regexp_matches(priority, '^[1-3]-')
)
select 'first' as run, count(*) as rejects from rejects union all select 'clean', 0""",
    "run_audit_failure": f"""with {MERGE},
n as (select cast(count(*) as varchar) as bad from batch
      where not coalesce(amount between 5000 and 450000, false))
select level, stage, case when stage = 'validate' then bad end as rejected_rows,
       case when stage = 'failure' then true end as traced
from n, (values ('INFO', 'init'), ('INFO', 'schema'), ('INFO', 'validate'), ('INFO', 'gate'),
                ('ERROR', 'failure')) e(level, stage)""",
    "run_audit": f"""with {LATEST_LINES},
counts as (
  select (select cast(count(*) as varchar) from lineitem) as n,
         (select cast(count(*) as varchar) from checked where error_reason is null) as c,
         (select cast((select count(*) from lineitem)
                      - count(*) filter (where error_reason is null) as double)
          from checked) as lost
),
events(level, stage, message, has_source, has_curated, has_loss) as (
  values ('INFO', 'init', 'Run started', false, false, false),
         ('INFO', 'read_input', 'Source counted', true, false, false),
         ('WARN', 'schema_validation', 'Source has columns outside the contract', false, false, false),
         ('INFO', 'schema_validation', 'Columns compared', false, false, false),
         ('INFO', 'write_output', 'Curated and rejects written', false, true, false),
         ('WARN', 'row_count_check', 'Row counts compared', true, true, true),
         ('INFO', 'complete', 'Run finished', false, false, false)
)
select 'transactions' as job_nm, 'transactions_20251114_083000' as job_id,
       level, stage, message,
       case when has_source then n end as source_rows,
       case when has_curated then c end as curated_rows,
       case when has_loss
            then cast(round(lost / cast(n as double) * 100, 2) as varchar) || '%' end as pct_loss
from events, counts""",
}
