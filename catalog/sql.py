"""SQL counterparts: named common table expressions and the builder that strings them together."""

from __future__ import annotations

import re

from catalog import fixtures as fx

ASCII_CODES = 128
# Punctuation that the fast form blanks, quoted for SQL.
PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCTUATION_COUNT = 32


def clean_text(c: str) -> str:
    return f"trim(regexp_replace(translate(lower(trim({c})), ',@.', ''), '\\s+', ' ', 'g'))"


def strip_suffixes(c: str) -> str:
    for suffix in ("t/t", "llc", "inc", "usa", "sa", "corporation", "corp", "co", "incorporated", "i"):
        c = f"regexp_replace({c}, ' {suffix}$', '')"
    return f"trim({c})"


def sorted_words(c: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_filter(string_split({c}, ' '), lambda w: w <> '')), ' '), '')"


def fast_form(c: str) -> str:
    return sorted_words(f"translate(lower({c}), '{PUNCTUATION}', repeat(' ', {PUNCTUATION_COUNT}))")


def fuzzy_form(c: str) -> str:
    kept = f"regexp_replace({c}, '[\\x{{0080}}-\\x{{00ff}}]', '', 'g')"
    return sorted_words(f"lower(regexp_replace({kept}, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'))")


def relation(columns: list[str], table: str, where: str = "true") -> str:
    listed = ", ".join(columns).replace("`", '"')
    return f"SELECT {listed} FROM {table} WHERE {where}"


CTES = {
    "items": " UNION ALL ".join(relation(c, "part") for c in fx.ITEMS),
    "brands": f"SELECT DISTINCT p_brand FROM part WHERE {fx.LISTED}",
    "alias_sheet": f"SELECT 1 AS row_no, * FROM ({relation(fx.ALIAS_OLD, 'brands')})"
    f" UNION ALL SELECT 2, * FROM ({relation(fx.ALIAS_NEW, 'brands')})",
    "aliases": "SELECT alias, arg_max(canonical, row_no * 10 + pos) AS canonical FROM ("
    "SELECT row_no, canonical, unnest([1, 2, 3]) AS pos, unnest([a1, a2, a3]) AS alias, n FROM alias_sheet)"
    " WHERE pos <= n GROUP BY alias",
    "keyword_sheet": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(fx.KEYWORD_ROWS))
    + ") AS t(row_no, keyword, full_name)",
    "keywords": "SELECT lower(keyword) AS keyword, arg_max(lower(full_name), row_no) AS full_name"
    " FROM keyword_sheet GROUP BY 1",
    "priority": f"SELECT row_no, item_description, clean_description, {fast_form('clean_description')}"
    ' AS processed_clean_desc FROM (SELECT p_partkey AS row_no, "Item Description" AS item_description,'
    f' "Clean Description" AS clean_description FROM ({relation(["p_partkey", *fx.PRIORITY], "part", fx.PROMOTED)}))',
    "class_products": f"SELECT *, {fast_form('proddesc')} AS prodcleandesc FROM ({relation(fx.CLASS_PRODUCTS, 'part')})",
    "maker_products": f"SELECT *, {fast_form('proddesc')} AS prodcleandesc FROM ({relation(fx.MAKER_PRODUCTS, 'part')})",
    "new_spend": relation(fx.NEW_SPEND, "part"),
    "price_lines": f"SELECT l_partkey, {', '.join(fx.PRICE_AGGREGATES)} FROM lineitem GROUP BY l_partkey",
    "prices": relation(fx.PRICE_COLUMNS, "price_lines JOIN part ON l_partkey = p_partkey"),
    "human": relation(fx.HUMAN_PRODUCTS, "part", f"NOT {fx.VET}"),
    "animal": relation(fx.ANIMAL_PRODUCTS, "part", fx.VET),
    "predictions": relation(fx.PREDICTIONS, "part"),
    "codes_by_drug": f"SELECT drug_name, {fx.JSON_BY_DRUG} AS response FROM"
    f" (SELECT DISTINCT {fx.FIRST_WORD} AS drug_name FROM part)",
    # Preparation of the items, step by step.
    "cleaned": f"SELECT *, lower(trim(replace(item_description, '@', ''))) AS clean_description,"
    f" {strip_suffixes(clean_text('manufacturer'))} AS clean_manufacturer,"
    " regexp_replace(trim(item_number), '^0+(.)', '\\1') AS clean_number FROM items",
    "keyed": "SELECT *, regexp_replace(clean_number || '#' || clean_manufacturer || '#' || clean_description,"
    " '\\s+', '_', 'g') AS key FROM cleaned",
    "marked": "SELECT *, row_number() OVER (PARTITION BY key ORDER BY row_id) > 1 AS is_duplicate FROM keyed",
    "canonical": "SELECT m.*, coalesce(a.canonical, 'UNKNOWN') AS canonical_manufacturer"
    " FROM marked m LEFT JOIN aliases a ON m.clean_manufacturer = a.alias",
    "named": "SELECT *, translate(regexp_extract(clean_description, '^(\\S*)', 1), ',.', '') AS drug_name,"
    " CASE WHEN regexp_matches(clean_description, '\\s') THEN regexp_extract(clean_description, '(?s)^\\S*\\s(.*)$', 1)"
    " END AS drug_strength FROM canonical",
    "tokens": "SELECT clean_description, unnest(w) AS keyword, unnest(range(1, len(w) + 1)) AS pos FROM (SELECT"
    " DISTINCT clean_description, regexp_split_to_array(clean_description, '\\s+') AS w FROM cleaned)",
    "keyword_hits": "SELECT clean_description, arg_min(keyword, pos) AS dosage, arg_min(full_name, pos) AS"
    " dosage_fullname, array_to_string(list_sort(list_distinct(list(full_name))), '|') AS keywords"
    " FROM tokens JOIN keywords USING (keyword) GROUP BY clean_description",
    "prepared": "SELECT n.*, coalesce(h.dosage, '') AS dosage, coalesce(h.dosage_fullname, '') AS dosage_fullname,"
    " coalesce(h.keywords, '') AS keywords, CASE WHEN h.dosage IS NULL THEN '' ELSE 'Drug' END AS tag"
    " FROM named n LEFT JOIN keyword_hits h USING (clean_description)",
    "numbered": "SELECT *, dense_rank() OVER (ORDER BY key) - 1 AS pim FROM prepared",
}


class Query:
    """A SELECT over named expressions, prefixed by those it reads; given expressions go before the library's."""

    def __init__(self, select: str, **ctes: str):
        self.select, self.ctes = select, {**CTES, **ctes}

    def __str__(self) -> str:
        ordered: list[str] = []

        def place(sql: str) -> None:
            for name in re.findall(r"\b(?:FROM|JOIN)\s+\(*(\w+)", sql):
                if name in self.ctes and name not in ordered:
                    place(self.ctes[name])
                    ordered.append(name)

        place(self.select)
        named = ",\n".join(f"{name} AS ({self.ctes[name]})" for name in ordered)
        return (f"WITH {named}\n" if named else "") + self.select


def score_ctes(pairs: str, digits: int) -> dict[str, str]:
    """Scores of the text pairs ``(a, b)`` of a relation, by the bit-vector recurrence on 128-bit integers."""
    zero, one = "CAST(0 AS HUGEINT)", "CAST(1 AS HUGEINT)"
    bit = f"CASE WHEN ascii(substr(a, CAST(p AS INTEGER) + 1, 1)) = c THEN {one} << CAST(p AS INTEGER) ELSE {zero} END"
    mask = (
        f"list_transform(range(0, {ASCII_CODES}), lambda c: list_reduce(list_prepend({zero},"
        f" list_transform(range(0, length(a)), lambda p: {bit})), lambda x, y: x | y))"
    )
    lcs = (
        "n - bit_count(list_reduce(list_prepend(full_mask, list_transform(codes, lambda c: masks[c + 1])),"
        " lambda v, m: ((v + (v & m)) | (v - (v & m))) & full_mask))"
    )
    return {
        "text_pairs": f"SELECT DISTINCT a, b FROM {pairs}",
        "left_masks": f"SELECT a, length(a) AS n, ({one} << length(a)) - 1 AS full_mask, {mask} AS masks"
        " FROM (SELECT DISTINCT a FROM text_pairs)",
        "right_codes": "SELECT b, length(b) AS m, list_transform(string_split(b, ''), lambda ch: ascii(ch)) AS codes"
        " FROM (SELECT DISTINCT b FROM text_pairs)",
        "scored": "SELECT a, b, lcs, n + m AS total, CASE WHEN n + m = 0 THEN CAST(100 AS DOUBLE) ELSE"
        f" round_even(CAST(100 AS DOUBLE) * (CAST(2 AS DOUBLE) * lcs / (n + m)), {digits}) END AS score"
        f" FROM (SELECT a, b, n, m, CASE WHEN n = 0 OR m = 0 THEN 0 ELSE {lcs} END AS lcs"
        " FROM text_pairs JOIN left_masks USING (a) JOIN right_codes USING (b))",
    }


LONG_WORD = 120


def long_score_ctes(pairs: str, digits: int) -> dict[str, str]:
    """Scores as above for texts of any length: the recurrence over lists of 128-bit words that hold ``LONG_WORD`` bits each, with the
    carry of the sum handed from word to word."""
    zero, one = "CAST(0 AS HUGEINT)", "CAST(1 AS HUGEINT)"
    full = f"(({one} << {LONG_WORD}) - 1)"
    words = f"range(0, greatest(1, (n + {LONG_WORD - 1}) // {LONG_WORD}))"
    bit = f"CASE WHEN substr(b, CAST(p AS INTEGER) + 1, 1) = ch THEN {one} << CAST(p % {LONG_WORD} AS INTEGER) ELSE {zero} END"
    in_word = f"list_transform(range({LONG_WORD} * w, least(n, {LONG_WORD} * (w + 1))), lambda p: {bit})"
    mask = f"list_transform({words}, lambda w: list_reduce(list_prepend({zero}, {in_word}), lambda x, y: x | y))"
    total = "(x[1] + (x[1] & x[2]) + acc[1])"
    added = f"list_prepend({total} >> {LONG_WORD}, list_append(acc[2:], ({total} & {full}) | (x[1] - (x[1] & x[2]))))"
    both = "list_transform(range(1, len(v) + 1), lambda i: [v[i], m[i]])"
    step = f"list_reduce(list_prepend([{zero}], {both}), lambda acc, x: {added})[2:]"
    states = "list_prepend(full_words, list_transform(string_split(a, ''), lambda ch: coalesce(masks[ch], none)))"
    kept = f"(({one} << CAST(least({LONG_WORD}, n - {LONG_WORD} * w) AS INTEGER)) - 1)"
    left = f"list_sum(list_transform({words}, lambda w: CAST(bit_count(folded[w + 1] & {kept}) AS BIGINT)))"
    return {
        "text_pairs": f"SELECT DISTINCT a, b FROM {pairs}",
        "patterns": f"SELECT b, n, list_transform({words}, lambda w: {full}) AS full_words, list_transform({words}, lambda w: {zero}) AS none,"
        f" map_from_entries(list_transform(list_distinct(string_split(b, '')), lambda ch: struct_pack(k := ch, v := {mask}))) AS masks"
        " FROM (SELECT DISTINCT b, length(b) AS n FROM text_pairs)",
        "folds": f"SELECT a, b, n, length(a) AS m, list_reduce({states}, lambda v, m: {step}) AS folded FROM text_pairs JOIN patterns USING (b)",
        "scored": "SELECT a, b, lcs, n + m AS total, CASE WHEN n + m = 0 THEN CAST(100 AS DOUBLE) ELSE"
        f" round_even(CAST(100 AS DOUBLE) * (CAST(2 AS DOUBLE) * lcs / (n + m)), {digits}) END AS score"
        f" FROM (SELECT a, b, n, m, CASE WHEN n = 0 OR m = 0 THEN 0 ELSE n - {left} END AS lcs FROM folds)",
    }


def best_ctes(items: str, candidates: str, cutoff: float, digits: int, k: int) -> dict[str, str]:
    """``best(block, text, cand_id, score, rank)`` for relations ``(block, text)`` and ``(block, text, cand_id)``."""
    return {
        "item_texts": f"SELECT DISTINCT block, text FROM ({items}) WHERE block IS NOT NULL",
        "cand_texts": f"SELECT DISTINCT block, text, cand_id FROM ({candidates}) WHERE block IS NOT NULL",
        "met": "SELECT block, i.text AS a, c.text AS b, c.cand_id FROM item_texts i JOIN cand_texts c USING (block)",
        **score_ctes("met", digits),
        "best": "SELECT block, a AS text, cand_id, score, rank FROM (SELECT block, a, cand_id, score, row_number() OVER"
        " (PARTITION BY block, a ORDER BY score DESC, cand_id) AS rank FROM met JOIN scored USING (a, b)"
        f" WHERE score >= {cutoff}) WHERE rank <= {k}",
    }
