"""Explicit schemas of every table that the engine reads or writes."""

RECORD = "date string, url string, lang string, type smallint, pos smallint, pre string, ngram string, post string"
FRAGMENT = "struct<pos:smallint,line_no:bigint,text:string>"
PIECES = "array<struct<pos:smallint,text:string>>"
SECTIONS = "array<struct<text:string,min_pos:smallint,max_pos:smallint,members:array<int>,stop_reason:string>>"
BEST_EFFORT = "struct<text:string,minimum_overlap:int,ordering:string,joins:array<struct<section:int,method:string,overlap:int>>,position_only_joins:int,comparison_budget_exhausted:boolean>"
DIAGNOSTICS = f"struct<minimum_overlap_used:int,stop_reason:string,search_status:string,conflicts:int,search_steps:int,primary_members:array<int>,segments:{SECTIONS},best_effort:{BEST_EFFORT}>"
RECOVERY1 = f"struct<text:string,merged:bigint,unmerged:{PIECES}>"
RECOVERY2 = f"struct<text:string,merged:bigint,unmerged:{PIECES},diagnostics:{DIAGNOSTICS}>"
BODY = "struct<text:string,joins:int,bounded:boolean>"
#: Metadata fields of a published row, in order.
METADATA = {
    "source_minute": "string", "raw_sha256": "string", "fragments": "bigint", "primary_fragments": "bigint", "assembly": "string",
    "position_joins": "bigint", "bounded_fallback": "boolean", "search": "string", "id": "bigint", "type_id": "bigint",
}
COMPACT = "date string, language string, source_url string, text string, observation_id string not null, type tinyint not null, metadata struct<" + ",".join(f"{k}:{v}" for k, v in METADATA.items()) + ">"
