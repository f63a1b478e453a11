"""SQL forms of the derived workload, shared by the twin queries."""

from distaff.constants import SYSTEM_TEMPLATE, TOOLS_SLOT

_HEAD, _TAIL = SYSTEM_TEMPLATE.split(TOOLS_SLOT)

EXAMPLES = """
examples as (
  select event_id as example_id,
    case when event_id % 11 = 0 then '[]' when event_id % 13 = 0 then null
         else '[{"name":"' || event_type || '","parameters":{"k":"int"}}]' end as tools,
    'user ' || cast(user_id as varchar) || ' asks about ' || event_type as user_turn,
    case when event_id % 19 = 0 then 'gpt' else 'human' end as first_from,
    case when event_id % 2 = 0 then 'function_call'
         when event_id % 23 = 0 then 'observation' else 'gpt' end as second_from,
    case when event_id % 2 = 0
         then '{"name":"' || event_type || '","arguments":' || props || '}'
         else 'Which ' || event_type || ' do you mean?' end as second_value,
    event_type, props
  from events)"""

PREDICTIONS = """
models as (
  select unnest([0, 1, 2, 3]) as m,
         unnest(['base', 'sft', 'distilled', 'teacher']) as model),
predictions as (
  select e.example_id, m.model,
    case (e.example_id + 3 * m.m * (e.example_id % 7)) % 10
      when 0 then '{"name":"' || e.event_type || '","arguments":' || e.props || '}'
      when 1 then '{"arguments":' || e.props || ',"name":"' || e.event_type || '"}'
      when 2 then 'Sure: {"name": "' || e.event_type || '", "arguments": ' || e.props || '} done'
      when 3 then '{"name":"other","arguments":' || e.props || '}'
      when 4 then '{"name":"' || e.event_type || '","arguments":{"k":-1}}'
      when 5 then '{"name":"' || e.event_type || '"}'
      when 6 then '{"name":"' || e.event_type || '","arguments":'
      when 7 then '{"name":"' || e.event_type || '"} and {"name":"x"}'
      when 8 then '{"note":"no name"}'
      else 'Could you tell me more?' end as completion
  from examples e join models m on true)"""

# The given tables hold no nested or repeated keys, NaN or trailing commas,
# where DuckDB's JSON validity would differ.
PARSED = """
blocks as (
  select *, regexp_extract(completion, '\\{.*\\}', 0, 's') as block from predictions),
parsed as (
  select *, block <> '' and json_valid(block) as any_json from blocks),
calls as (
  select example_id, model, completion, block, any_json,
    any_json and json_exists(case when any_json then block end, '$.name') as has_name,
    cast(json_extract(case when any_json then block end, '$.name') as varchar) as pred_name,
    cast(json(json_extract(case when any_json then block end, '$.arguments')) as varchar)
      as pred_args
  from (select example_id, model, completion, block, coalesce(any_json, false) as any_json
        from parsed))"""

SCORED = """
scored as (
  select c.example_id, c.model, e.user_turn, c.completion, c.any_json,
    coalesce(c.has_name, false) as pred_is_call,
    e.second_from = 'function_call' as gt_is_call,
    case when e.second_from = 'function_call' then '"' || e.event_type || '"' end as gt_name,
    case when e.second_from = 'function_call' then cast(json(e.props) as varchar) end as gt_args,
    c.pred_name, c.pred_args,
    coalesce(c.has_name and c.pred_name = '"' || e.event_type || '"'
      and e.second_from = 'function_call', false) as correct_name,
    coalesce(c.has_name and c.pred_name = '"' || e.event_type || '"'
      and e.second_from = 'function_call'
      and coalesce(c.pred_args, '{}') = cast(json(e.props) as varchar), false) as exact_args
  from examples e join calls c on e.example_id = c.example_id
  where coalesce(e.tools, '') not in ('', '[]') and e.first_from = 'human'),
misses as (
  select model, example_id, user_turn, gt_name, gt_args, pred_name, pred_args,
         correct_name as name_matched
  from scored where gt_is_call and not exact_args)"""

PAIRED = """
paired as (
  select c.*, e.second_from = 'function_call' as expects_call
  from examples e join calls c on e.example_id = c.example_id
  where coalesce(e.tools, '') not in ('', '[]') and e.first_from = 'human'),
classified as (
  select *,
    case when expects_call and has_name then 'function_call'
         when not expects_call and not any_json then 'clarify_or_decline' end
      as expected_behavior,
    case when expects_call and not has_name then 'failed_call'
         when not expects_call and any_json then 'hallucinated_call' end as drop_reason
  from paired)"""

PROMPTS = f"""
prompts as (
  select *, '{_HEAD}' || case when coalesce(tools, '[]') = '[]' then '[]' else '[
  {{
    "name": "' || event_type || '",
    "parameters": {{
      "k": "int"
    }}
  }}
]' end || '{_TAIL}' as system_prompt
  from examples)"""

SPLIT = """
ranked as (
  select *, row_number() over (order by md5('3407-' || example_id), example_id) as r,
         count(*) over () as n
  from usable),
split as (
  select *, case when r <= ceil(n * 0.08e0) then 'test' else 'train' end as split from ranked)"""

USABLE = """
usable as (select * from examples where coalesce(tools, '') not in ('', '[]'))"""

POSITIONS = """
positions as (
  select t.vec_id, t.embedding as teacher, s.embedding as student,
    case when t.vec_id % 5 = 0 then -100 else cast(t.vec_id % 64 as integer) end as label
  from embeddings t join embeddings s on s.vec_id = t.vec_id + 1),
entries as (
  select vec_id, label, unnest(range(64)) as token_id,
    cast(unnest(teacher) as double) as t, cast(unnest(student) as double) as s
  from positions)"""


def logprobs(temperature: float) -> str:
    """CTE ``lp``: log-probabilities of both sides, one row per token."""
    return f"""
norms as (
  select vec_id, ln(sum(exp(t / {temperature}e0))) as zt, ln(sum(exp(s / {temperature}e0))) as zs
  from entries group by vec_id),
lp as (
  select e.vec_id, e.label, e.token_id, e.t / {temperature}e0 - n.zt as lt,
         e.s / {temperature}e0 - n.zs as ls
  from entries e join norms n on e.vec_id = n.vec_id)"""


RUN_LOG = """
run_log as (
  select 'run-' || (event_id % 8) as run, event_id // 8 as step, ts,
    case when event_id % 97 = 0 then 'nan'::double else value end as loss,
    2e-5 * case when event_id % 8 < 4 and event_id // 8 < 30 then (event_id // 8) / 30e0
      when event_id % 8 < 4 then greatest(0e0, 1e0 - ((event_id // 8) - 30) / 1970e0)
      else greatest(0e0, 1e0 - (event_id // 8) / 2000e0) end as lr
  from events)"""
GAPPED_LOG = RUN_LOG.rstrip(")") + " where event_type <> 'error')"


def with_ctes(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


CALLS_SQL = with_ctes(EXAMPLES, PREDICTIONS, PARSED)
SCORED_SQL = with_ctes(EXAMPLES, PREDICTIONS, PARSED, SCORED)
PAIRED_SQL = with_ctes(EXAMPLES, PREDICTIONS, PARSED, PAIRED)
EXAMPLES_SQL = with_ctes(EXAMPLES)
PROMPTS_SQL = with_ctes(EXAMPLES, PROMPTS)
SPLIT_SQL = with_ctes(EXAMPLES, USABLE, SPLIT)
POSITIONS_SQL = with_ctes(POSITIONS)
RUN_LOG_SQL = with_ctes(RUN_LOG)
GAPPED_LOG_SQL = with_ctes(GAPPED_LOG)
