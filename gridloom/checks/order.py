"""Row-order operators on events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.checks.registry import query
from gridloom.operators.ordered import (
    RowOrder,
    carry_forward,
    look_around,
    number_rows,
    running_sum,
)

W = "window w as (partition by user_id order by ts, event_id)"


def by_user():
    return RowOrder(["user_id"], ["ts", "event_id"], F.unix_micros(F.col("ts").cast("timestamp")))


def events(t, *more):
    return t.events.select("user_id", "ts", "event_id", "event_type", *more)


def is_type(kind):
    return F.col("event_type") == kind


@query(
    "q_forward_fill",
    f"""select user_id, event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls)
         over (w rows between unbounded preceding and current row) as section_id from events {W}""",
)
def forward_fill(t):
    marker = F.when(is_type("signup"), F.col("event_id"))
    return carry_forward(events(t), by_user(), {"section_id": marker}).select("user_id", "event_id", "section_id")


@query(
    "q_occurrence",
    """with n as (select event_id, event_type, row_number() over (partition by user_id, event_type order by ts, event_id)
         as n from events)
       select event_id, case when n > 1 then event_type || '(' || n || ')' else event_type end as label from n""",
)
def occurrence(t):
    numbered = number_rows(events(t), by_user().with_keys("event_type"), "n")
    label = F.when(F.col("n") > 1, F.concat("event_type", F.lit("("), F.col("n"), F.lit(")")))
    return numbered.select("event_id", F.coalesce(label, "event_type").alias("label"))


@query(
    "q_block_match",
    f"""with b as (select user_id, event_id, event_type, value, lead(event_type) over w as next_type,
         lead(value) over w as next_value, lead(event_id) over w as next_id from events {W})
       select user_id, event_id, value, next_id, next_value from b where event_type = 'view' and next_type = 'click'""",
)
def block_match(t):
    def ahead(w):
        return {
            "next_type": F.lead("event_type").over(w),
            "next_value": F.lead("value").over(w),
            "next_id": F.lead("event_id").over(w),
        }

    seen = look_around(events(t, "value"), by_user(), 0, 1, ahead)
    whole = seen.filter(is_type("view") & (F.col("next_type") == "click"))
    return whole.select("user_id", "event_id", "value", "next_id", "next_value")


@query(
    "q_four_row_block",
    f"""with b as (select user_id, event_id, event_type, lead(event_type, 1) over w as t1, lead(event_type, 2) over w as t2,
         lead(event_type, 3) over w as t3, lead(value, 3) over w as v3 from events {W})
       select user_id, event_id, v3 from b where event_type <> t1 and event_type <> t2 and event_type <> t3""",
)
def four_row_block(t):
    def ahead(w):
        types = {f"t{i}": F.lead("event_type", i).over(w) for i in (1, 2, 3)}
        return {**types, "v3": F.lead("value", 3).over(w)}

    seen = look_around(events(t, "value"), by_user(), 0, 3, ahead)
    kind = F.col("event_type")
    whole = seen.filter((kind != F.col("t1")) & (kind != F.col("t2")) & (kind != F.col("t3")))
    return whole.select("user_id", "event_id", "v3")


@query(
    "q_state_gate",
    """with s as (select user_id, min(event_id) as start from (select user_id, event_id, row_number() over
           (partition by user_id order by ts, event_id) as rn from events where event_type = 'signup') where rn = 1 group by 1),
       o as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events),
       a as (select o.user_id, o.rn as start_rn from o join s on o.event_id = s.start),
       z as (select o.user_id, min(o.rn) as stop_rn from o join a on o.user_id = a.user_id
           where o.event_type = 'error' and o.rn > a.start_rn group by 1)
       select o.user_id, o.event_id, o.event_type from o join a on o.user_id = a.user_id left join z on o.user_id = z.user_id
       where o.rn > a.start_rn and (z.stop_rn is null or o.rn < z.stop_rn)""",
)
def state_gate(t):
    rows = events(t)
    by = by_user().measured(rows)
    starts = running_sum(rows, by, {"starts": F.when(is_type("signup"), 1).otherwise(0)})
    stop = F.when(is_type("error") & (F.col("starts") > 0), 1).otherwise(0)
    gated = running_sum(starts, by, {"stops": stop})
    first = is_type("signup") & (F.col("starts") == 1)
    inside = gated.filter((F.col("starts") > 0) & (F.col("stops") == 0) & ~first)
    return inside.select("user_id", "event_id", "event_type")


@query(
    "q_section_span",
    """with o as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events),
       m as (select user_id, event_id, rn, lead(event_id) over (partition by user_id order by rn) as next_id,
         lead(rn) over (partition by user_id order by rn) as next_rn from o where event_type = 'signup')
       select user_id, event_id as section_id, next_id as next_section_id, next_rn - rn - 1 as rows_inside from m""",
)
def section_span(t):
    rows = events(t)
    by = by_user().measured(rows)
    markers = number_rows(rows, by, "rn").filter(is_type("signup"))

    def following(w):
        return {"next_id": F.lead("event_id").over(w), "next_rn": F.lead("rn").over(w)}

    spans = look_around(markers, by, 0, 1, following)
    return spans.select(
        "user_id",
        F.col("event_id").alias("section_id"),
        F.col("next_id").alias("next_section_id"),
        (F.col("next_rn") - F.col("rn") - 1).alias("rows_inside"),
    )


@query(
    "q_lookahead",
    f"""select user_id, event_id, coalesce(max(case when event_type = 'error' then 1 else 0 end)
         over (w rows between 1 following and 4 following), 0) as error_ahead from events {W}""",
)
def lookahead(t):
    def flag(w):
        hit = F.when(is_type("error"), 1).otherwise(0)
        return {"error_ahead": F.coalesce(F.max(hit).over(w.rowsBetween(1, 4)), F.lit(0))}

    return look_around(events(t), by_user(), 0, 4, flag).select("user_id", "event_id", "error_ahead")


@query(
    "q_lookback",
    f"""select user_id, event_id, first_value(case when event_type = 'signup' then event_id end ignore nulls)
         over (w rows between 5 preceding and 1 preceding) as marker_before from events {W}""",
)
def lookback(t):
    def marker(w):
        found = F.when(is_type("signup"), F.col("event_id"))
        return {"marker_before": F.first(found, ignorenulls=True).over(w.rowsBetween(-5, -1))}

    return look_around(events(t), by_user(), 5, 0, marker).select("user_id", "event_id", "marker_before")


@query(
    "q_hierarchy",
    """with c as (select conv_id, turn, role, text, last_value(case when role <> 'assistant' then text end ignore nulls) over
         (partition by conv_id order by turn rows between unbounded preceding and current row) as category
         from conversations)
       select conv_id, turn, category, case when role = 'assistant' then text else '' end as subcategory
       from c where category is not null""",
)
def hierarchy(t):
    lines = t.conversations.select(
        "conv_id", "turn", F.when(F.col("role") == "assistant", F.concat(F.lit(" " * 8), "text")).otherwise(F.col("text")).alias("cell")
    )
    child = F.col("cell").startswith(" " * 8)
    placed = carry_forward(lines, RowOrder(["conv_id"], ["turn"], F.col("turn")), {"category": F.when(~child, F.col("cell"))})
    sub = F.when(child, F.substring("cell", 9, 1 << 30)).otherwise("")
    return placed.filter("category is not null").select("conv_id", "turn", "category", sub.alias("subcategory"))
