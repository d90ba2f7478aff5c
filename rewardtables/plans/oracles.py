"""SQL equivalents of the registered queries, for an in-process SQL engine.

They restate definitions independently of the Spark code: windows where that
joins, sorted percentiles where that counts, regular expressions of another
dialect. Derived tables appear as common table expressions of the same name as
in ``fixtures.py``.
"""

from __future__ import annotations

from rewardtables.constants import PY_WHITESPACE, RISK_SYSTEM_PROMPT, SYSTEM_PROMPT

_WS = "||".join(f"chr({ord(c)})" for c in PY_WHITESPACE)
_NL = "chr(10)"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(e: str) -> str:
    return f"trim({e}, {_WS})"


def _xml(e: str) -> str:
    return _strip(f"split_part(split_part({e}, '<answer>', -1), '</answer>', 1)")


def _hash(e: str) -> str:
    return f"case when contains({e}, '####') then {_strip(f'''split_part({e}, '####', 2)''')} end"


def _cot(reasoning: str, answer: str) -> str:
    return (
        f"('<reasoning>'||{_NL}||{reasoning}||{_NL}||'</reasoning>'||{_NL}||'<answer>'||{_NL}||"
        f"{answer}||{_NL}||'</answer>'||{_NL})"
    )


def _strict(e: str) -> str:
    pattern = r"^<reasoning>\n.*?\n</reasoning>\n<answer>\n.*?\n</answer>\n\n?$"
    return f"case when regexp_matches({e}, '{pattern}') then 0.5 else 0.0 end::double"


def _correct(e: str, answer: str) -> str:
    return f"case when {_xml(e)} = {answer} then 2.0 else 0.0 end::double"


def _length(e: str) -> str:
    return f"(-abs(20 - length({e})))::double"


def _tagged(e: str, tag: str, allowed: str) -> str:
    answer = _xml(e)
    tail = f"split_part({answer}, '<{tag}>', -1)"
    value = f"lower({_strip(f'''split_part({tail}, '</{tag}>', 1)''')})"
    return (
        f"case when contains({answer}, '<{tag}>') and contains({tail}, '</{tag}>') "
        f"and {value} in ({allowed}) then {value} end"
    )


def _chat(system: str, user: str) -> str:
    def turn(role: str, content: str) -> str:
        return (
            f"'<|start_header_id|>{role}<|end_header_id|>'||{_NL}||{content}||'<|eot_id|>'"
        )

    return (
        f"({turn('system', _text(system))}||{turn('user', user)}||"
        f"'<|start_header_id|>assistant<|end_header_id|>'||{_NL})"
    )


def _hash52(text: str) -> str:
    return f"cast('0x'||substr(md5({text}), 1, 13) as bigint)"


def _words(e: str) -> str:
    return f"list_filter(string_split_regex({e}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"


def _r6(e: str) -> str:
    return f"round({e}, 6) + 0.0"


_LATER = (
    f"('<returns_5y>'||coalesce(pred_ret_5y, 'up')||'</returns_5y>'||{_NL}||'<volatility_5y>'||"
    f"coalesce(pred_vol_5y, 'huge')||'</volatility_5y>'||{_NL})"
)
_RETURNS = "'bad', 'neutral', 'good'"
_VOLATILITY = "'low', 'medium', 'high'"
_LEVELS = "'low risk', 'moderate risk', 'high risk', 'very high risk'"
_ORD = (
    "case when {t} = 'returns' then case {b} when 'bad' then 0 when 'neutral' then 1 "
    "when 'good' then 2 end else case {b} when 'low' then 0 when 'medium' then 1 "
    "when 'high' then 2 end end"
)

_CTES = {
    "completions": f"""
      select conv_id, turn, variant, prompt, answer, text,
        case variant
          when 0 then {_cot('line', 'answer')}
          when 1 then {_cot('text', 'answer')}
          when 2 then '<reasoning>'||{_NL}||line||{_NL}||'</reasoning>'||{_NL}||'<answer>'||{_NL}||answer
          when 3 then '<answer>7</answer><answer>  '||answer||chr(9)||'</answer>'
          when 4 then text
          when 5 then {_cot('line', "'wrong'")}||{_NL}
          when 6 then rtrim({_cot('line', 'answer')}, {_NL})
          else 'junk '||{_cot('line', 'answer')}
        end as completion
      from (
        select a.conv_id, a.turn, cast((a.conv_id + a.turn) % 8 as int) as variant,
          u.text as prompt, cast(a.conv_id * 10 + a.turn as varchar) as answer, a.text,
          replace(a.text, {_NL}, ' ') as line
        from conversations a join conversations u
          on u.conv_id = a.conv_id and u.turn = a.turn - 1
        where a.role = 'assistant' and u.role = 'user')""",
    "qa": f"""
      select item_id, text as question, case item_id % 5
          when 0 then text
          when 1 then text||{_NL}||'#### '||item_id
          when 2 then text||' ####'||item_id||' #### tail'
          when 3 then '####'||chr(9)||(item_id * 1000)||',500'||{_NL}
          else '#####'||item_id end as answer
      from benchmark""",
    "bench": f"""
      select doc_id as item_key, lang as instruction, source as input,
        upper(lang||'-'||(doc_id % 4)) as output,
        case doc_id % 3 when 0 then '[INST] q [/INST] '||lang||'-'||(doc_id % 4)||' '
          when 1 then 'x[/INST]y[/INST]'||{_NL}||lang||'-'||(doc_id % 4)
          else lang||'-'||(doc_id % 5) end as generated
      from documents""",
    "predictions": """
      select l.doc_id, n_chars, text,
        case when toxic = 1 then 'bad' when quality = 1 and l.doc_id % 4 <> 0 then 'good'
          else 'neutral' end as gt_ret_1y,
        case when l.doc_id % 13 = 0 then null when n_chars < 300 then 'low'
          when n_chars < 1500 then 'medium' else 'high' end as gt_vol_1y,
        case when n_chars % 11 = 0 then null when n_chars % 5 = 0 then 'bad'
          when n_chars % 3 = 0 then 'neutral' when toxic = 1 then 'bad'
          when quality = 1 and l.doc_id % 4 <> 0 then 'good' else 'neutral' end as pred_ret_1y,
        case when n_chars % 7 = 0 then null when n_chars < 500 then 'low'
          when n_chars < 1000 then 'medium' else 'high' end as pred_vol_1y,
        case when quality = 1 and l.doc_id % 3 <> 0 then 'good' when toxic = 1 then 'bad'
          else 'neutral' end as gt_ret_5y,
        case when n_chars < 600 then 'low' when n_chars < 2500 then 'medium'
          else 'high' end as gt_vol_5y,
        case when n_chars % 13 = 0 then null when n_chars % 4 = 0 then 'good'
          when quality = 1 and l.doc_id % 3 <> 0 then 'good' when toxic = 1 then 'bad'
          else 'neutral' end as pred_ret_5y,
        case when n_chars % 9 = 0 then null when n_chars < 800 then 'low'
          when n_chars < 2000 then 'medium' else 'high' end as pred_vol_5y
      from labels l join documents d on l.doc_id = d.doc_id""",
    "band_texts": f"""
      select doc_id, case when doc_id % 7 = 0 then null else doc_id % 6 <> 0 end as is_grpo_task,
        text as prompt, gt_ret_1y as ground_truth_returns_1y,
        gt_vol_1y as ground_truth_volatility_1y, gt_ret_5y as ground_truth_returns_5y,
        gt_vol_5y as ground_truth_volatility_5y,
        case doc_id % 5 when 0 then coalesce(pred_ret_1y, 'up')
          when 1 then text||{_NL}||'<answer>'||{_NL}||'<returns_1y>bad</returns_1y>'||{_NL}||
            '</answer>'||{_NL}||'<answer>'||{_NL}||'<returns_1y>  '||
            upper(coalesce(pred_ret_1y, 'up'))||'  </returns_1y>'||{_NL}||'<volatility_1y>'||chr(9)||
            upper(coalesce(pred_vol_1y, 'huge'))||{_NL}||'</volatility_1y>'||{_NL}||upper({_LATER})||{_LATER}||'</answer>'
          else {_cot('text', f'''('<returns_1y>'||coalesce(pred_ret_1y, 'up')||'</returns_1y>'||{_NL}||
            '<volatility_1y>'||coalesce(pred_vol_1y, 'huge')||'</volatility_1y>'||{_NL}||{_LATER}||
            '<risk_level>'||case doc_id % 4 when 0 then 'low risk' when 1 then 'Moderate Risk'
              when 2 then 'very high risk' else 'none' end||'</risk_level>')''')}
        end as completion
      from predictions""",
    "parsed": f"""
      select doc_id, is_grpo_task, ground_truth_returns_1y as gt_ret_1y,
        ground_truth_volatility_1y as gt_vol_1y,
        ground_truth_returns_5y as gt_ret_5y, ground_truth_volatility_5y as gt_vol_5y,
        {_tagged('completion', 'returns_1y', _RETURNS)} as pred_ret_1y,
        {_tagged('completion', 'volatility_1y', _VOLATILITY)} as pred_vol_1y,
        {_tagged('completion', 'returns_5y', _RETURNS)} as pred_ret_5y,
        {_tagged('completion', 'volatility_5y', _VOLATILITY)} as pred_vol_5y,
        cast({_hash52("'42:'||doc_id")} % 5 as int) as fold
      from band_texts""",
    "pairs": """
      select * from (
        select 'returns' as band_type, gt_ret_1y as gt, pred_ret_1y as pred from predictions
        union all select 'volatility', gt_vol_1y, pred_vol_1y from predictions)
      where gt is not null and pred is not null""",
    "parsed_pairs": """
      select band_type, horizon, gt, pred, unnest([fold, -1]) as fold from (
        select 'returns' as band_type, '1y' as horizon, gt_ret_1y as gt, pred_ret_1y as pred, fold, is_grpo_task
          from parsed
        union all select 'volatility', '1y', gt_vol_1y, pred_vol_1y, fold, is_grpo_task from parsed
        union all select 'returns', '5y', gt_ret_5y, pred_ret_5y, fold, is_grpo_task from parsed
        union all select 'volatility', '5y', gt_vol_5y, pred_vol_5y, fold, is_grpo_task from parsed)
      where is_grpo_task and gt is not null and pred is not null""",
    "horizon_pairs": """
      select * from (
        select 'returns' as band_type, '1y' as horizon, gt_ret_1y as gt, pred_ret_1y as pred
          from predictions
        union all select 'volatility', '1y', gt_vol_1y, pred_vol_1y from predictions
        union all select 'returns', '5y', gt_ret_5y, pred_ret_5y from predictions
        union all select 'volatility', '5y', gt_vol_5y, pred_vol_5y from predictions)
      where gt is not null and pred is not null""",
    "fold_metrics": f"""
      select fold, metric, value from (
        select fold, unnest([
          struct_pack(metric := 'accuracy', value := avg(hit)),
          struct_pack(metric := 'accuracy_good', value := avg(hit) filter (gt_ret_1y = 'good')),
          struct_pack(metric := 'n_rows', value := count(*)::double)], recursive := true)
        from (select cast({_hash52("'42:'||doc_id")} % 5 as int) as fold, gt_ret_1y,
          (gt_ret_1y = pred_ret_1y)::int::double as hit from predictions)
        group by fold)
      where not (fold = 0 and metric = 'accuracy_good')""",
    "fold_metrics_gap": "select * from fold_metrics where fold <> 3",
    "rollouts": f"""
      select event_id, event_id // 7 as grp, value as reward, ts,
        case when event_id % 3 = 1 then '> ' else '' end||{_cot('props', 'event_type')} as completion,
        case when user_id % 4 = 0 then 'click' else event_type end as answer
      from events""",
    "responses": """
      select event_id, event_id // 8 as batch_id, range(1, event_id % 4 + 2) as prompt_ids,
        case event_id % 4 when 0 then [[user_id, event_id % 97 + 1], [9]]
          when 1 then [[user_id, 7, 8]] when 2 then [[event_id % 13]] else [[9]] end as ids
      from events""",
    "sequences": """
      select event_id, batch_id, prompt_ids, i - 1 as pos, ids[i] as seq
      from (select *, unnest(range(1, len(ids) + 1)) as i from responses)""",
    "padded": """
      select event_id, batch_id, pos, prompt_ids, seq,
        seq || list_resize(cast([] as bigint[]),
          max(len(seq)) over (partition by batch_id) - len(seq), 0) as padded
      from sequences""",
    "checkpoints": """
      select *, 'runs/'||run||'/'||name as path from (
      select o_custkey as run, case o_orderkey % 6 when 4 then 'checkpoint-'||o_orderkey||'x'
          when 5 then 'my-checkpoint-'||o_orderkey else 'checkpoint-'||o_orderkey end as name,
        o_orderkey % 7 <> 3 as is_dir
      from orders)""",
    "series": """
      select o_orderpriority as ticker, cast(date_trunc('month', o_orderdate) as date) as month,
        avg(o_totalprice) as price
      from orders
      group by 1, 2""",
    "series_gaps": """
      select * from series
      where not (ticker = '5-LOW' and (year(month) * 12 + month(month)) % 17 = 0)""",
    "daily_series": """
      select case when o_orderkey % 3 = 0 then 'HOT' else o_orderpriority end as ticker,
        cast(o_orderdate as date) as day, avg(o_totalprice) as price
      from orders where isodow(o_orderdate) <= 5 group by 1, 2""",
    "response_lines": """
      select event_id % 11 as fault, ids, case event_id % 4
          when 0 then '{"completion_ids":[['||ids[1][1]||','||ids[1][2]||'],[]]}'
          when 1 then '{"outputs":[{"token_ids":['||ids[1][1]||',7,8]}]}'
          when 2 then '{"completion_ids":[],"outputs":[{"token_ids":['||ids[1][1]||']}]}'
          else '{"completion_ids":[],"outputs":[]}' end as whole
      from responses""",
    "returns": """
      select a.*, a.price / b.price as ratio, case when a.price / b.price > 0
        then ln(a.price / b.price) end as log_return
      from series a left join series b
        on b.ticker = a.ticker and b.month = a.month - interval 1 month""",
    "volatility": """
      select a.ticker, a.month,
        stddev_samp(b.log_return) filter (b.month <= a.month + interval 12 month) as v,
        stddev_samp(b.log_return) as v5
      from returns a left join returns b on b.ticker = a.ticker
        and b.month > a.month and b.month <= a.month + interval 60 month
      group by 1, 2""",
    "returns_by_fold": f"""
      select doc_id, '1y' as horizon, pred_ret_1y as band, cast({_hash52("'42:'||doc_id")} % 5 as int) as fold
        from predictions
      union all select doc_id, '5y', pred_ret_5y, cast({_hash52("'42:'||doc_id")} % 5 as int) from predictions""",
    "parsed_returns": """
      select doc_id, '1y' as horizon, pred_ret_1y as band, fold from parsed where is_grpo_task
      union all select doc_id, '5y', pred_ret_5y, fold from parsed where is_grpo_task""",
    "draws": """
      select horizon, fold, mean + std * sqrt(-2.0 * ln(u1)) * cos(2.0 * pi() * u2) as x
      from (
        select horizon, fold, case band when 'bad' then -0.15 when 'neutral' then 0.05 else 0.20 end::double as mean,
          case band when 'bad' then 0.20 when 'neutral' then 0.15 else 0.25 end::double as std,
          (cast('0x'||substr(h, 1, 13) as bigint) + 0.5) / 4503599627370496.0::double as u1,
          (cast('0x'||substr(h, 14, 13) as bigint) + 0.5) / 4503599627370496.0::double as u2
        from (select horizon, fold, band, md5(doc_id||':'||i) as h
          from returns_by_fold, range(1, 1001) t(i) where band is not null))""",
    # per horizon and fold, the total as fold -1
    "tails": """
      select g.horizon, g.fold, any_value(g.var) as var, avg(d.x) filter (d.x <= g.var) as cvar,
        count(*) // 1000 as n_predictions
      from (select horizon, f as fold, quantile_cont(x, 0.05) as var
            from (select horizon, x, unnest([fold, -1]) as f from draws) group by all) g
      join (select horizon, x, unnest([fold, -1]) as fold from draws) d
        on d.horizon = g.horizon and d.fold = g.fold
      group by g.horizon, g.fold""",
}
_CTES["parsed_draws"] = _CTES["draws"].replace("from returns_by_fold,", "from parsed_returns,")
_CTES["parsed_tails"] = _CTES["tails"].replace("from draws", "from parsed_draws")

_NEEDS = {
    "band_texts": ["predictions"],
    "parsed": ["band_texts"],
    "pairs": ["predictions"],
    "parsed_pairs": ["parsed"],
    "horizon_pairs": ["predictions"],
    "fold_metrics": ["predictions"],
    "fold_metrics_gap": ["fold_metrics"],
    "series_gaps": ["series"],
    "sequences": ["responses"],
    "response_lines": ["responses"],
    "padded": ["sequences"],
    "returns": ["series"],
    "volatility": ["returns"],
    "returns_by_fold": ["predictions"],
    "parsed_returns": ["parsed"],
    "draws": ["returns_by_fold"],
    "parsed_draws": ["parsed_returns"],
    "tails": ["draws"],
    "parsed_tails": ["parsed_draws"],
}


def _with(body: str, *names: str, **more: str) -> str:
    """``body`` behind the common table expressions it names, dependencies first."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} as ({_CTES[n]})" for n in order] + [f"{n} as ({q})" for n, q in more.items()]
    return f"with {', '.join(parts)} {body}"


def _metric_ctes(source: str, by: str) -> dict[str, str]:
    keys = [k.strip() for k in by.split(",")]
    on = " and ".join(f"s.{k} = c.{k}" for k in keys)
    g = _ORD.format(t="band_type", b="gt")
    p = _ORD.format(t="band_type", b="pred")
    return {
        "scored": f"select *, {g} as g, {p} as p from {source}",
        "label_set": f"select {by}, gt as label from {source} union select {by}, pred from {source}",
        "label_f1": f"""
          select {', '.join('s.' + k for k in keys)}, label,
            count(*) filter (c.gt = label) as support,
            count(*) filter (c.pred = label) as predicted,
            count(*) filter (c.gt = label and c.pred = label) as tp
          from label_set s join {source} c on {on}
          group by {', '.join('s.' + k for k in keys)}, label""",
        "f1": f"""
          select {by}, sum(case when support + predicted > 0 then 2.0 * tp / (support + predicted)
            else 0 end * support) / sum(support) as f1 from label_f1 group by {by}""",
        "base": f"""
          select {by}, count(*) as n, count(*) filter (g is null or p is null) as n_unmapped,
            avg((gt = pred)::int) as accuracy,
            avg((g - p) * (g - p)) filter (g is not null and p is not null) as mse,
            case when count(*) filter (p is not null) < 2 then null
              when var_pop(g) filter (p is not null) = 0 then
                case when sum((g - p) * (g - p)) = 0 then 1.0 else 0.0 end
              else 1.0 - sum((g - p) * (g - p)) / (count(*) filter (g is not null and p is not null)
                * var_pop(g) filter (p is not null)) end as r2
          from scored group by {by}""",
    }


def _metrics(source: str, by: str, needs: list[str], columns: str) -> str:
    keys = ", ".join(k.strip() for k in by.split(","))
    return _with(
        f"select {keys}, {columns} from base join f1 using ({keys})",
        *needs,
        **_metric_ctes(source, by),
    )


_ALL_METRICS = (
    f"n, n_unmapped, {_r6('accuracy')} as accuracy, {_r6('mse')} as mse, "
    f"{_r6('f1')} as f1_weighted, {_r6('r2')} as r2"
)
_MEASURES = (
    f"count(*) as n, {_r6('avg((c > 0)::int)')} as accuracy, {_r6('avg(c)')} as mean_correctness, "
    f"{_r6('avg(f)')} as mean_strict_format, {_r6('avg(l)')} as mean_length"
)
_SCORES = (
    f"{_correct('completion', 'answer')} as c, {_strict('completion')} as f, "
    f"{_length('completion')} as l"
)


def oracle_sql() -> dict[str, str]:
    long_month = "cast(year(month) * 12 + month(month) - 1 as int) as month_no"
    summary = (
        f"select metric, {_r6('avg(value) filter (not isnan(value))')} as mean, "
        f"{_r6('stddev_samp(value) filter (not isnan(value))')} as std_dev "
    )
    # (fold, metric, value) of the whole evaluation, the total as fold -1
    metric_values = f"""
      select fold, unnest(['accuracy_'||band_type||'_'||horizon, 'mse_'||band_type||'_'||horizon,
          'f1_weighted_'||band_type||'_'||horizon, 'r2_score_'||band_type||'_'||horizon]) as metric,
        unnest([accuracy, mse, f1, r2]) as value
      from base join f1 using (band_type, horizon, fold)"""
    evaluated = f"""
      {metric_values}
      union all select fold, unnest(['portfolio_VaR_95', 'portfolio_CVaR_95'])||
          case horizon when '1y' then '' else '_'||horizon end, unnest([var, cvar])
      from parsed_tails"""
    by_fold = _metric_ctes("parsed_pairs", "band_type, horizon, fold")
    fold_nan = (
        "select fold, metric, case when fold = 1 and metric = 'accuracy_good' "
        "then 'nan'::double else value end as value from fold_metrics"
    )
    return {
        "xml_answer_extract": _with(
            f"select conv_id, turn, {_xml('completion')} as extracted from completions", "completions"
        ),
        "hash_answer_extract": _with(
            f"select item_id, question, {_hash('answer')} as answer from qa", "qa"
        ),
        "reward_correctness": _with(
            f"select conv_id, turn, answer, {_correct('completion', 'answer')} as reward "
            "from completions",
            "completions",
        ),
        "reward_strict_format": _with(
            f"select conv_id, turn, {_strict('completion')} as reward from completions", "completions"
        ),
        "reward_length": _with(
            f"select conv_id, turn, {_length('completion')} as reward from completions", "completions"
        ),
        "reward_scorecard": _with(
            f"""select variant, count(*) as n, {_r6('avg(c)')} as mean_correctness,
              {_r6('avg(f)')} as mean_strict_format, {_r6('avg(l)')} as mean_length,
              {_r6('avg(c + f + l)')} as mean_total
              from (select variant, {_SCORES} from completions) group by variant""",
            "completions",
        ),
        "reward_scorecard_rows": _with(
            "select conv_id, turn, c as reward_correctness, f as reward_strict_format, "
            f"l as reward_length, c + f + l as reward_total from (select *, {_SCORES} from completions)",
            "completions",
        ),
        "python_reward": _with(
            """select conv_id, turn, (length(completion) - length(replace(completion, '</', '/')))::double
              as reward from completions""",
            "completions",
        ),
        "cot_render_roundtrip": _with(
            f"""select conv_id, turn, {_xml('rendered')} as extracted, {_strict('rendered')} as reward,
              {_xml('rendered')} = answer as same
              from (select *, {_cot(f"replace(text, {_NL}, ' ')", 'answer')} as rendered
                from completions)""",
            "completions",
        ),
        "chat_prompt_build": _with(
            f"""select 'qa' as src, item_id as id, 0::bigint as turn,
                {_chat(SYSTEM_PROMPT, 'question')} as chat, {_hash('answer')} as answer,
                question as last_user from qa
              union all
              select 'conversation', conv_id, turn, {_chat(SYSTEM_PROMPT, 'text')}, null, text
              from conversations where role = 'user'""",
            "qa",
        ),
        "prompt_tail_truncate": f"""
            select doc_id, len(words)::int as n_tokens,
              array_to_string(case when len(words) <= 64 then words else words[-64:] end, ' ') as tail
            from (select doc_id, {_words('text')} as words from documents)""",
        "format_prompts": f"""
            select doc_id, case when len(words) <= 2048 then chat
              else right(chat, length(array_to_string(words[-2048:], ''))
                + length(array_to_string(gaps[-2048:], ''))) end as prompt
            from (select doc_id, chat, {_words('chat')} as words,
                string_split_regex(chat, '[^ \\t\\n\\x0B\\f\\r]+') as gaps
              from (select doc_id, {_chat(RISK_SYSTEM_PROMPT, 'text')} as chat from documents))""",
        "tokenizer_tail_truncate": f"""
            select doc_id, right({_chat(RISK_SYSTEM_PROMPT, 'text')}, 500) as prompt from documents""",
        "instruction_concat_first_n": _with(
            f"""select item_key, instruction||{_NL}||input as prompt from bench
              order by item_key limit 100""",
            "bench",
        ),
        "first_rows_in_source_order": _with(
            f"""select instruction||{_NL}||input as prompt, output, generated
              from bench order by item_key limit 100""",
            "bench",
        ),
        "benchmark_result_rows": _with(
            f"""select item_key, instruction||{_NL}||input as prompt, prediction,
                output as answer, lower(prediction) = lower(output) as correct
              from (select *, {_strip("split_part(generated, '[/INST]', -1)")} as prediction
                from bench)""",
            "bench",
        ),
        "benchmark_exact_match": _with(
            f"""select count(*) as n, sum(hit)::bigint as n_correct, {_r6('avg(hit)')} as accuracy
              from (select ({_strip("lower(split_part(generated, '[/INST]', -1))")} = lower(output))::bigint
                as hit from bench)""",
            "bench",
        ),
        "benchmark_exact_match_all": _with(
            f"""select instruction, count(*) as n, sum(hit)::bigint as n_correct,
                {_r6('avg(hit)')} as accuracy
              from (select instruction,
                ({_strip("lower(split_part(generated, '[/INST]', -1))")} = lower(output))::bigint as hit
                from bench) group by instruction""",
            "bench",
        ),
        "parse_band_prediction": _with(
            "select doc_id, gt_ret_1y, gt_vol_1y, pred_ret_1y, pred_vol_1y, gt_ret_5y, gt_vol_5y, pred_ret_5y, pred_vol_5y from parsed", "parsed"
        ),
        "parse_risk_level": _with(
            f"select doc_id, {_tagged('completion', 'risk_level', _LEVELS)} as risk_level "
            "from band_texts",
            "band_texts",
        ),
        "grpo_task_filter": _with(
            """select doc_id, ground_truth_returns_1y, ground_truth_volatility_1y
              from band_texts where is_grpo_task""",
            "band_texts",
        ),
        "confusion_counts": _with(
            "select band_type, gt, pred, count(*) as n from pairs group by all", "pairs"
        ),
        "band_ordinals": _with(
            f"""select doc_id, band_type, band, {_ORD.format(t='band_type', b='band')} as ord
              from (select doc_id, 'returns' as band_type, pred_ret_1y as band from predictions
                union all select doc_id, 'volatility', pred_vol_1y from predictions)""",
            "predictions",
        ),
        "band_accuracy": _metrics("pairs", "band_type", ["pairs"], f"n, {_r6('accuracy')} as accuracy"),
        "band_mse": _metrics(
            "pairs", "band_type", ["pairs"], f"n, n_unmapped, {_r6('mse')} as mse"
        ),
        "band_f1_weighted": _metrics(
            "pairs", "band_type", ["pairs"], f"n, {_r6('f1')} as f1_weighted"
        ),
        "band_r2": _metrics("pairs", "band_type", ["pairs"], f"n, n_unmapped, {_r6('r2')} as r2"),
        "band_metrics_all": _metrics("pairs", "band_type", ["pairs"], _ALL_METRICS),
        "band_metrics_by_horizon": _metrics(
            "horizon_pairs", "band_type, horizon", ["horizon_pairs"], _ALL_METRICS
        ),
        "evaluation_metric_map": _with(
            f"select metric, {_r6('value')} as value from ({evaluated}) where fold = -1",
            "parsed_pairs", "parsed_tails", **by_fold,
        ),
        "kfold_evaluation": _with(
            f"select case when fold >= 0 then fold end as fold, metric, {_r6('value')} as value from ({evaluated})",
            "parsed_pairs", "parsed_tails", **by_fold,
        ),
        "kfold_summary": _with(
            f"""select metric, {_r6('avg(value)')} as mean, {_r6('stddev_samp(value)')} as std_dev
              from ({evaluated}) where fold >= 0 group by metric""",
            "parsed_pairs", "parsed_tails", **by_fold,
        ),
        "metric_sink_roundtrip": _with(
            f"select metric, {_r6('value')} as value from ({metric_values}) where fold = -1",
            "parsed_pairs", **by_fold,
        ),
        "confusion_state_stream": _metrics("pairs", "band_type", ["pairs"], _ALL_METRICS),
        "var_cvar_by_fold": _with(
            f"""select horizon, case when fold >= 0 then fold end as fold, {_r6('var')} as var, {_r6('cvar')} as cvar,
              n_predictions from tails""",
            "tails",
        ),
        "var_cvar_unusable": _with(
            """select avg(x) as var, min(x) as cvar, count(x) as n_predictions
              from (select null::double as x from predictions where pred_vol_1y in ('bad', 'neutral', 'good'))""",
            "predictions",
        ),
        "var_cvar_simulated": _with(
            f"""select {_r6('var')} as var, {_r6('cvar')} as cvar, n_predictions
              from tails where horizon = '1y' and fold = -1""",
            "tails",
        ),
        "var_cvar_mixture": _with(
            # the mixture's density summed over narrow cells instead of a closed form
            f"""select {_r6('x + 0.00005 - (cum - 0.05) / m * 0.0001')} as var,
                {_r6('(below - (cum - 0.05) * x) / 0.05')} as cvar, n_predictions
              from (select *, row_number() over (order by x) as r from cells where cum >= 0.05)
              where r = 1""",
            "predictions",
            band_counts="""
              select case pred_ret_1y when 'bad' then -0.15 when 'neutral' then 0.05 else 0.20 end::double as mean,
                case pred_ret_1y when 'bad' then 0.20 when 'neutral' then 0.15 else 0.25 end::double as std,
                count(*) as n
              from predictions where pred_ret_1y is not null group by all""",
            density="""
              select x, sum(n * exp(-0.5 * ((x - mean) / std) ** 2) / (std * sqrt(2 * pi())))
                  / sum(n) * 0.0001 as m, sum(n)::bigint as n_predictions
              from (select -3.0::double + (i + 0.5) * 0.0001 as x from range(60000) t(i)), band_counts
              group by x""",
            cells="""
              select x, m, n_predictions, sum(m) over (order by x) as cum,
                sum(m * x) over (order by x) as below from density""",
        ),
        "kfold_assign": _with(
            f"select doc_id, cast({_hash52("'42:'||doc_id")} % 5 as int) as fold from predictions",
            "predictions",
        ),
        "holdout_split": _with(
            f"""select doc_id, case when {_hash52("'42:'||doc_id")} / 4503599627370496.0::double < 0.2
              then 'test' else 'train' end as split from predictions""",
            "predictions",
        ),
        "load_fold_sides": _with(
            f"""select doc_id, case when {_hash52("'42:'||doc_id")} % 5 = 2 then 'test' else 'train' end
              as side from predictions""",
            "predictions",
        ),
        "fold_metric_summary": _with(
            summary + "from with_nan group by metric", "fold_metrics", with_nan=fold_nan
        ),
        "append_fold_records": _with(
            f"""select fold, metric, {_r6('value')} as value from (
              select fold, metric, value from fold_metrics
              union all select 0, 'accuracy_good', null)""",
            "fold_metrics",
        ),
        "split_table_scan": _with(
            f"""select question, answer, 'test' as split from qa
              where {_hash52("'42:'||item_id")} / 4503599627370496.0::double < 0.2""",
            "qa",
        ),
        "fold_file_summary": _with(
            summary + "from with_nan where fold <> 3 group by metric", "fold_metrics", with_nan=fold_nan
        ),
        "missing_folds": _with(
            """select i::int as fold from range(5) t(i)
              where i not in (select fold from fold_metrics_gap)""",
            "fold_metrics_gap",
        ),
        "fold_status": _with(
            """select i::int as fold, i in (select fold from fold_metrics_gap) as found
              from range(5) t(i)""",
            "fold_metrics_gap",
        ),
        "result_sink_roundtrip": _with(
            "select doc_id, gt_ret_1y, gt_vol_1y, pred_ret_1y, pred_vol_1y from predictions",
            "predictions",
        ),
        "group_relative_advantage": _with(
            f"""select event_id, grp, reward, {_r6('''(reward - avg(reward) over w)
                / (coalesce(stddev_samp(reward) over w, 0) + 1e-4)''')} as advantage
              from rollouts window w as (partition by grp)""",
            "rollouts",
        ),
        "rollout_scoring": _with(
            f"""select event_id, grp, t as reward_total, {_r6('''(t - avg(t) over w)
                / (coalesce(stddev_samp(t) over w, 0) + 1e-4)''')} as advantage
              from (select event_id, grp, c + f + l as t
                from (select event_id, grp, {_SCORES} from rollouts)) window w as (partition by grp)""",
            "rollouts",
        ),
        "response_normalise": _with(
            "select event_id, pos::int as pos, array_to_string(seq, ',') as ids from sequences",
            "sequences",
        ),
        "response_log_scan": _with(
            "select array_to_string(seq, ',') as ids, count(*) as n from sequences group by 1",
            "sequences",
        ),
        "response_log_quarantine": _with(
            """select kind, content, count(*) as n from (
                select 'good' as kind, array_to_string(unnest(ids), ',') as content
                  from response_lines where fault > 4
                union all select case fault when 0 then 'not JSON' when 1 then 'wrong type' when 2 then 'blank'
                    when 3 then 'not an object' else 'not JSON' end,
                  case fault when 0 then substr(whole, 1, length(whole) - 3)
                    when 1 then '{"completion_ids":"lost"}' when 2 then '  ' when 3 then '[1,2]'
                    else 'timed out' end
                  from response_lines where fault <= 4) group by all""",
            "response_lines",
        ),
        "log_pairing": _with(
            f"""select row_number() over (order by conv_id, turn) - 1 as position, answer,
                {_correct(f"replace(completion, {_NL}, ' ')", 'answer')} as reward
              from completions""",
            "completions",
        ),
        "positional_pairing": _with(
            """select event_id, pos::int as pos, array_to_string([prompt_ids[i]||':'||seq[i]
                for i in range(1, least(len(prompt_ids), len(seq)) + 1)], ',') as pairs
              from sequences""",
            "sequences",
        ),
        "pad_batch": _with(
            """select event_id, batch_id, pos::int as pos, array_to_string(padded, ',') as ids
              from padded""",
            "padded",
        ),
        "concat_prompt_completion": _with(
            """select event_id, pos::int as pos, array_to_string(prompt_ids || padded, ',') as ids
              from padded""",
            "padded",
        ),
        "ensure_new_token": _with(
            """select event_id, pos::int as pos, array_to_string(case when len(o) = len(prompt_ids)
                then o || [9::bigint] else o end, ',') as ids
              from (select event_id, pos, prompt_ids,
                case when seq = [9] then prompt_ids else prompt_ids || seq end as o
                from sequences)""",
            "sequences",
        ),
        "latest_checkpoint": _with(
            """select run, arg_max(path, step) as path, arg_max(name, step) as latest, max(step) as step
              from (select run, path, name, cast(regexp_extract(name, '^checkpoint-([0-9]+)$', 1) as bigint)
                as step from checkpoints
                where is_dir and regexp_matches(name, '^checkpoint-[0-9]+$'))
              group by run""",
            "checkpoints",
        ),
        "checkpoint_steps": _with(
            """select run, path, name, is_dir, cast(nullif(regexp_extract(name, '^checkpoint-([0-9]+)$', 1), '')
              as bigint) as step from checkpoints""",
            "checkpoints",
        ),
        "periodic_eval": _with(
            f"""select eval_step, {_MEASURES} from (
                select eval_step, {_SCORES} from (
                  select event_id // 100 * 100 as eval_step, completion, answer,
                    row_number() over (partition by event_id // 100
                      order by {_hash52("'42:'||event_id")}, event_id) as r
                  from rollouts) where r <= 32)
              group by eval_step""",
            "rollouts",
        ),
        "windowed_eval": _with(
            f"""select strftime(cast(ts as date), '%Y-%m-%d') as day, {_MEASURES}
              from (select ts, {_SCORES} from rollouts)
              group by 1""",
            "rollouts",
        ),
        "streaming_sample": _with(
            f"""select eval_step, {_MEASURES} from (
                select eval_step, {_SCORES} from (
                  select event_id // 100 * 100 as eval_step, completion, answer,
                    row_number() over (partition by event_id // 100
                      order by {_hash52("'42:'||event_id")}, event_id) as r
                  from rollouts) where r <= 32)
              group by eval_step""",
            "rollouts",
        ),
        "streaming_eval": _with(
            f"""select strftime(cast(ts as date), '%Y-%m-%d') as day, {_MEASURES}
              from (select ts, {_SCORES} from rollouts)
              group by 1""",
            "rollouts",
        ),
        "forward_return": _with(
            f"""select a.ticker, cast(year(a.month) * 12 + month(a.month) - 1 as int) as month_no,
                {_r6('b.price / a.price - 1')} as return_1y, {_r6('c.price / a.price - 1')} as return_5y
              from series a
              left join series b on b.ticker = a.ticker and b.month = a.month + interval 12 month
              left join series c on c.ticker = a.ticker and c.month = a.month + interval 60 month""",
            "series",
        ),
        "forward_return_gaps": _with(
            f"""select a.ticker, cast(year(a.month) * 12 + month(a.month) - 1 as int) as month_no,
                {_r6('b.price / a.price - 1')} as forward_return
              from series_gaps a
              left join series_gaps b on b.ticker = a.ticker and b.month = a.month + interval 12 month""",
            "series_gaps",
        ),
        "forward_return_asof": _with(
            f"""select a.ticker, strftime(a.day, '%Y-%m-%d') as day,
                {_r6("case when b.day >= a.day + interval 12 month - interval 7 day then b.price end / a.price - 1")}
                  as return_1y
              from daily_series a asof left join daily_series b
                on b.ticker = a.ticker and a.day + interval 12 month >= b.day""",
            "daily_series",
        ),
        "forward_volatility": _with(
            f"select ticker, {long_month}, {_r6('v')} as volatility_1y, {_r6('v5')} as volatility_5y "
            "from volatility", "volatility"
        ),
        "return_band": _with(
            """select a.ticker, cast(year(a.month) * 12 + month(a.month) - 1 as int) as month_no,
                case when r is null then null when r < -0.05 then 'bad' when r < 0.05 then 'neutral'
                  else 'good' end as band_1y,
                case when r5 is null then null when r5 < -0.1 then 'bad' when r5 < 0.1 then 'neutral'
                  else 'good' end as band_5y
              from (select a.ticker, a.month, b.price / a.price - 1 as r, c.price / a.price - 1 as r5
                from series a
                left join series b on b.ticker = a.ticker and b.month = a.month + interval 12 month
                left join series c on c.ticker = a.ticker and c.month = a.month + interval 60 month) a""",
            "series",
        ),
        "volatility_band": _with(
            f"""select ticker, {long_month}, case when v is null then null when v < 0.1 then 'low'
                when v < 0.2 then 'medium' else 'high' end as band_1y,
                case when v5 is null then null when v5 < 0.1 then 'low'
                when v5 < 0.2 then 'medium' else 'high' end as band_5y from volatility""",
            "volatility",
        ),
        "history_window": _with(
            """select a.ticker, cast(year(a.month) * 12 + month(a.month) - 1 as int) as month_no,
                string_agg(strftime(b.month, '%Y%m'), ',' order by b.month) as months,
                count(*)::int as n_months, round(sum(b.price), 2) as price_sum,
                any_value(m.n_orders) as n_orders
              from series a join series b on b.ticker = a.ticker and b.month <= a.month
                and b.month > a.month - interval 240 month
              join (select o_orderpriority as ticker, cast(date_trunc('month', o_orderdate) as date)
                as month, count(*) as n_orders from orders group by all) m
                on m.ticker = a.ticker and m.month = a.month
              group by a.ticker, a.month""",
            "series",
        ),
    }
