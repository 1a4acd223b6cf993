"""Schemas of the stored tables."""

SEED = "struct<block_id:string,category:string,exclude_reason:string,genre:string,kind:string,new_since_seed:boolean,title:string,type:string>"
AREA = f"struct<edited:boolean,id:string,origin:string,rect:array<double>,seed:{SEED},type:string,type_source:string>"
OPENING = "struct<area_id:string,cls:string,cls_source:string,confidence:double,containment:double,detector_source:string,edited:boolean,flags:array<string>,group_id:string,id:string,origin:string,rect:array<double>,seed:struct<confidence:double,rect:array<double>>,state:string>"
ANNOTATION = (
    "sheet_key string, project_id string, planset_key string, file string, pdf_sha256 string, page bigint, rotation bigint, page_rect_pt array<double>, "
    "render struct<h:bigint,image:string,w:bigint,zoom:double>, rev bigint, schema_version bigint, status string, skip_reason string, time_spent_s bigint, "
    f"notes string, updated_at string, areas array<{AREA}>, openings array<{OPENING}>"
)
WORDS = "file string, page int, word int, block int, line int, text string, x0 double, y0 double, x1 double, y1 double"
LINES = "file string, page int, block int, line int, ord int, text string, size double, x0 double, y0 double, x1 double, y1 double"
BOXES = "sheet_key string, box_id bigint, conf double, cls string, source string, x0 double, y0 double, x1 double, y1 double"
REVISIONS = "sheet_key string, rev bigint, base_rev bigint, op string, payload string, updated_at timestamp"
