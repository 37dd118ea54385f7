"""Names the data product is defined by.

Fixed values: the column names and their order are the product's contract, so they are
listed here as plain text, once.
"""

# Planning dates are wall-clock times: they have no zone.
WALL_CLOCK = "timestamp_ntz"

# Logical columns of one call-detail row (one row per call and product detailed).
CALL_COLUMNS = """
afl_nm afl_id src_cntry_id brik_nm brik_id regn_nm sf_nm
pri_st_cd pri_city pri_zip pri_addr_ln1 pri_addr_ln2
terr_nm terr_id unasgn_flg ta prod_nm src_prod_nm
src_acnt_id src_acnt_nm src_brik_id src_brik_nm src_mastr_acnt_id src_mastr_acnt_nm
src_prnt_brik_id src_prnt_brik_nm src_user_id
cust_nm cust_id cegedim veeva_id pri_phn_num prnt_cust_id prnt_cust_nm
clsfn src_clsfn pri_spec_cd cdtl cdtl_cd spec cust_stat ntnl_prfssnal
ety_clas_cd ety_clas_desc prnt_ety_clas_cd prnt_ety_clas_desc role
prnt_cust_stat prnt_cust_type prnt_pracr_type prnt_pri_addr_ln1 prnt_pri_addr_ln2
prnt_pri_city prnt_pri_cntry prnt_pri_phn_num prnt_pri_spec_cd
call_dt rsm_nm ts_nm call_id call_nm call_stat call_typ call_dtl_nm call_dtl_id
intractn_typ prnt_call_id is_prnt_cl rec_type rmt_call_mthd venu_ms vid_call_sftwr
wtg field_team_type brd_nm
""".split()

SAMPLE_COLUMNS = """
objection_gild_e__c ms_slide_decks_used_gild__c discussion_topics_gild__c
call_discussion_name actions_gild__c indication__C comments__c quantity_vod__c
prod_type call_sample_name sample_name
""".split()

HISTORY_COLUMNS = "source_g360_product_detailed entity_display_name_vod__c is_clm_call".split()

GEO_COLUMNS = """
affiliate_subterritory_id affiliate_subterritory_name
subterritory_hiearachy_level_1 subterritory_hiearachy_level_2 subterritory_hiearachy_level_3
brick_hierarchy_level_1 brick_hierarchy_level_2 brick_hierarchy_level_3
""".split()

CYCLE_COLUMNS = "spl_cyc ta afl_id strt_dt end_dt sgmnt_prty cust_id".split()
CALENDAR_COLUMNS = "afl_id ta spl_cyc strt_dt end_dt".split()

# The 0/1 columns that make plain sums right, and the columns that, with the call id, form
# the group in which exactly one row carries the 1.
FLAG_GRAINS = {
    "overall_number_of_actual_calls": [],
    "number_of_product_details": ["brd_nm"],
    "number_of_therapy_area_actual_calls": ["ta"],
}

# The data product, in order: "output name" or "output name=column it is made from".
OUTPUT = [
    tuple(entry.split("=")) if "=" in entry else (entry, entry)
    for entry in """
global_region_name global_subregion_name affiliate_name=afl_nm country_name
country_code=src_cntry_id brick_name=brik_nm brick_id=brik_id affiliate_region_name=regn_nm
salesforce_name=sf_nm state_name=pri_st_cd city_name=pri_city zip_post_code=pri_zip
primary_address_line_1=pri_addr_ln1 primary_address_line_2=pri_addr_ln2
primary_address_line_3 primary_address_line_4 territory_name=terr_nm territory_id=terr_id
territory_status affiliate_subterritory_name affiliate_subterritory_id
unassigned_flag=unasgn_flg subterritory_hiearachy_level_1 subterritory_hiearachy_level_2
subterritory_hiearachy_level_3 brick_hierarchy_level_1 brick_hierarchy_level_2
brick_hierarchy_level_3 therapy_area_TA=ta product_name=prod_nm
source_g360_product_detailed source_product_name=src_prod_nm data_source_name
source_account_id=src_acnt_id source_account_name=src_acnt_nm source_brick_id=src_brik_id
source_brick_name=src_brik_nm source_master_account_id=src_mastr_acnt_id
source_master_account_name=src_mastr_acnt_nm source_parent_brick_id=src_prnt_brik_id
source_parent_brick_name=src_prnt_brik_nm source_user_id=src_user_id hcp_name=cust_nm
hcp_eid=cust_id cegedim_id=cegedim veeva_id primary_phone_number=pri_phn_num
master_account_id=prnt_cust_id master_account_name=prnt_cust_nm classification=clsfn
source_classification=src_clsfn primary_specialty_code=pri_spec_cd credential=cdtl
credential_code=cdtl_cd customer_speciality=spec customer_status=cust_stat prioritization
national_professional_id=ntnl_prfssnal entity_class_code=ety_clas_cd
entity_class_description=ety_clas_desc role ims_landscape_germany_only
parent_customer_name=prnt_cust_nm parent_customer_id=prnt_cust_id
parent_customer_status=prnt_cust_stat parent_customer_type=prnt_cust_type
parent_entity_class_code=prnt_ety_clas_cd parent_entity_class_description=prnt_ety_clas_desc
parent_practicioner_type=prnt_pracr_type parent_primary_address_line_1=prnt_pri_addr_ln1
parent_primary_address_line_2=prnt_pri_addr_ln2 parent_primary_city=prnt_pri_city
parent_primary_country=prnt_pri_cntry parent_primary_phone_number=prnt_pri_phn_num
parent_primary_specialty_code=prnt_pri_spec_cd call_date=call_dt cycle rsm_name=rsm_nm
ts_name=ts_nm ms_name call_id call_name=call_nm call_status=call_stat call_type=call_typ
call_type_detail=call_dtl_nm call_type_detail_id=call_dtl_id field_team_type
interaction_type parent_call_id=prnt_call_id is_parent_call=is_prnt_cl record_type=rec_type
remote_call_method=rmt_call_mthd venue_ms=venu_ms video_call_software=vid_call_sftwr
promotional_call_yn overall_number_of_actual_calls number_of_product_details
number_of_therapy_area_actual_calls call_weightage=wtg objection_gild_e__c
ms_slide_decks_used_gild__c discussion_topics_gild__c call_discussion_name actions_gild__c
indication__C comments__c quantity_vod__c prod_type call_sample_name sample_name
entity_display_name_vod__c last_data_refresh_timestamp affiliate_code=afl_id is_clm_call
""".split()
]

# Call columns that operators read; the rest of a call travels as one packed column. (The weight
# is a floating point number, which a grouping would take out of the pack and put back.)
READ_COLUMNS = """
call_id src_prod_nm prod_nm brd_nm ta afl_id src_cntry_id brik_id terr_id cust_id call_dt pri_zip pri_city wtg
""".split()

# Packed columns and what they hold. Few wide columns instead of a hundred narrow ones: every join
# and sort in between copies a row's bytes and no more.
PACKED = {
    "rest": [c for c in CALL_COLUMNS if c not in READ_COLUMNS],
    "country": ["country_name", "global_region_name", "global_subregion_name"],
    "geo": GEO_COLUMNS,
    "history": HISTORY_COLUMNS,
    "sample": SAMPLE_COLUMNS,
}

# Order that decides, after the cycle end date, which row of a group is the first: ascending, NULLs
# first. It has every column that can differ between two rows of one call, those that usually
# differ first.
TIEBREAK = """
src_prod_nm prod_nm brd_nm ta spl_cyc cycle_end afl_id src_cntry_id brik_id terr_id cust_id call_dt pri_zip pri_city
wtg rest territory_status listed_flag country geo history sample
""".split()
