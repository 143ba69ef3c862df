"""The sixteen typed loads (C4–C19) as data.

fixed values: the source column names below (spelling, case, blanks and
misspellings included) are those the partner files carry and must stay as
they are; where a partner spells a name two ways, both are accepted. Target
names are ours, lower-case. Kinds: text, number (half-up whole number),
number? (lenient), int/bigint (half-up, 64-bit), float, comma_float ("1,234.5"),
percent ("95%"), array, decimal(10,5)?, date:<format>, date?, timestamp,
timestamp?, ts_date (timestamp text -> date).
"""

from __future__ import annotations

from .loads import F_, LoadSpec, Period

CATALOGUE_AUDIT = ("source_key", "loaded_ts", "run_id")

ASSET_REPORT = LoadSpec("asset_report", (
    F_("date", "date:yyyy-MM-dd", "Date"),
    F_("node_id", "bigint", "Node_ID"),
    F_("node_title", "text", "Node_Title"),
    F_("total_watch_duration", "bigint", "Total_Watch_Duration"),
    F_("completion_percent", "float", "Completion %"),
    F_("uid", "bigint", "UID"),
    F_("channel_name", "text", "Channel_Name"),
    F_("channel_id", "bigint", "Channel_ID"),
    F_("vendor6_views", "int", "Vendor6_Views"),
    F_("vendor3_views", "int", "Vendor3_Views", " Vendor3_Views"),
    F_("other_views", "int", "Other_Views"),
    F_("total_views", "int", "Total_Views"),
    F_("unique_ad_requests", "int", "Unique_Ad_Requests"),
), Period("params"))

_V1_KEYS = (
    F_("date", "text", "date"),
    F_("channel_id", "text", "channel_id"),
)
_V1_DIMS = (
    F_("vendor1_item_id", "text", "item_id"),
    F_("live_or_on_demand", "text", "live_or_on_demand"),
    F_("subscribed_status", "text", "subscribed_status"),
    F_("country_code", "text", "country_code"),
)
_V1_PERIOD = Period("row_date", ("date",), "yyyyMMdd")

BASIC_METRICS = LoadSpec("basic_metrics", _V1_KEYS + _V1_DIMS + (
    F_("views", "number", "views"),
    F_("comments", "number", "comments"),
    F_("likes", "number", "likes"),
    F_("dislikes", "number", "dislikes"),
    F_("shares", "number", "shares"),
    F_("watch_time_minutes", "number", "watch_time_minutes"),
    F_("average_view_duration_seconds", "float", "average_view_duration_seconds"),
    F_("average_view_duration_percentage", "float", "average_view_duration_percentage"),
    F_("annotation_impressions", "number", "annotation_impressions"),
    F_("annotation_clickable_impressions", "number", "annotation_clickable_impressions"),
    F_("annotation_clicks", "number", "annotation_clicks"),
    F_("annotation_click_through_rate", "number", "annotation_click_through_rate"),
    F_("annotation_closable_impressions", "number", "annotation_closable_impressions"),
    F_("annotation_closes", "number", "annotation_closes"),
    F_("annotation_close_rate", "number", "annotation_close_rate"),
    F_("card_teaser_impressions", "number", "card_teaser_impressions"),
    F_("card_teaser_clicks", "number", "card_teaser_clicks"),
    F_("card_teaser_click_rate", "number", "card_teaser_click_rate"),
    F_("card_impressions", "number", "card_impressions"),
    F_("card_clicks", "number", "card_clicks"),
    F_("card_click_rate", "number", "card_click_rate"),
    F_("subscribers_gained", "number", "subscribers_gained"),
    F_("subscribers_lost", "number", "subscribers_lost"),
    F_("items_added_to_playlists", "number", "items_added_to_playlists"),
    F_("items_removed_from_playlists", "number", "items_removed_from_playlists"),
    F_("red_views", "number", "red_views"),
    F_("red_watch_time_minutes", "number", "red_watch_time_minutes"),
), _V1_PERIOD, constants=("channel_name",))

DEMOGRAPHICS = LoadSpec("demographics", _V1_KEYS + _V1_DIMS + (
    F_("age_group", "text", "age_group"),
    F_("gender", "text", "gender"),
    F_("views_percentage", "float", "views_percentage"),
), _V1_PERIOD, constants=("channel_name",))

DEVICE_TYPE = LoadSpec("device_type", _V1_KEYS + _V1_DIMS + (
    F_("device_type", "text", "device_type"),
    F_("operating_system", "text", "operating_system"),
    F_("views", "number", "views"),
    F_("watch_time_minutes", "number", "watch_time_minutes"),
    F_("average_view_duration_seconds", "float", "average_view_duration_seconds"),
    F_("average_view_duration_percentage", "float", "average_view_duration_percentage"),
    F_("red_views", "number", "red_views"),
    F_("red_watch_time_minutes", "number", "red_watch_time_minutes"),
), _V1_PERIOD, constants=("channel_name",))

TRAFFIC_SOURCE = LoadSpec("traffic_source", (
    F_("average_view_duration_percentage", "float", "average_view_duration_percentage"),
    F_("average_view_duration_seconds", "float", "average_view_duration_seconds"),
    F_("channel_id", "text", "channel_id"),
    F_("country_code", "text", "country_code"),
    F_("date", "text", "date"),
    F_("live_or_on_demand", "text", "live_or_on_demand"),
    F_("red_views", "number", "red_views"),
    F_("red_watch_time_minutes", "number", "red_watch_time_minutes"),
    F_("subscribed_status", "text", "subscribed_status"),
    F_("traffic_source_detail", "text", "traffic_source_detail"),
    F_("traffic_source_type", "text", "traffic_source_type"),
    F_("vendor1_item_id", "text", "item_id"),
    F_("views", "number", "views"),
    F_("watch_time_minutes", "number", "watch_time_minutes"),
), _V1_PERIOD, constants=("channel_name",))

FINANCE = LoadSpec("finance", (
    F_("ad_impressions", "text", "adImpressions"),
    F_("annotation_clickthrough_rate", "number", "annotationClickThroughRate"),
    F_("annotation_clickable_impressions", "number", "annotationClickableImpressions"),
    F_("annotation_clicks", "number", "annotationClicks"),
    F_("annotation_closable_impressions", "number", "annotationClosableImpressions"),
    F_("annotation_close_rate", "number", "annotationCloseRate"),
    F_("annotation_closes", "number", "annotationCloses"),
    F_("annotation_impressions", "number", "annotationImpressions"),
    F_("average_view_duration", "number", "averageViewDuration"),
    F_("average_view_pct", "float", "averageViewPercentage"),
    F_("card_click_rate", "number", "cardClickRate"),
    F_("card_clicks", "number", "cardClicks"),
    F_("card_impressions", "number", "cardImpressions"),
    F_("card_teaser_clickrate", "number", "cardTeaserClickRate", "cardTeasertClickRate"),
    F_("card_teaser_clicks", "number", "cardTeaserClicks"),
    F_("card_teaser_impressions", "number", "cardTeaserImpressions"),
    F_("channel_id", "text", "channel_id"),
    F_("comment_desc", "number", "comments"),
    F_("country_cd", "text", "country"),
    F_("cpm", "float", "cpm"),
    F_("dislikes_nbr", "number", "dislikes"),
    F_("end_date_text", "text", "end_date"),
    F_("est_ad_revenue", "float", "estimatedAdRevenue"),
    F_("est_minutes_watched", "number", "estimatedMinutesWatched"),
    F_("est_redminutes_watched", "number", "estimatedRedMinutesWatched"),
    F_("est_redpartner_revenue", "float", "estimatedRedPartnerRevenue"),
    F_("est_revenue", "float", "estimatedRevenue"),
    F_("gross_revenue", "float", "grossRevenue"),
    F_("likes_nbr", "number", "likes"),
    F_("monetized_playbacks", "number", "monetizedPlaybacks"),
    F_("playback_based_cpm", "float", "playbackBasedCpm"),
    F_("redviews_nbr", "number", "redViews"),
    F_("shares_nbr", "number", "shares"),
    F_("start_date_text", "text", "start_date"),
    F_("subscribers_gained_nbr", "number", "subscribersGained"),
    F_("subscribers_lost", "number", "subscribersLost"),
    F_("vendor1_item_id", "text", "item_id"),
    F_("items_added_to_playlists", "number", "itemsAddedToPlaylists"),
    F_("items_removed_from_playlists", "number", "itemsRemovedFromPlaylists"),
    F_("views_nbr", "number", "views"),
), Period("row_pair", ("start_date", "end_date"), "yyyy-MM-dd"), constants=("channel_name",))

REVENUE_V3 = LoadSpec("revenue_v3", (
    F_("title_or_itemset_id", "text", "Title/ItemSet ID"),
    F_("asin", "text", "ASIN"),
    F_("title_name", "text", "Title Name"),
    F_("itemset_name", "text", "ItemSet Name"),
    F_("itemset_name_alt", "text", "ItemSet Name"),
    F_("consumption_type", "text", "Consumption Type"),
    F_("quality", "text", "Quality"),
    F_("unit_price", "comma_float", "Unit Price"),
    F_("quantity", "comma_float", "Quantity"),
    F_("is_refund", "text", "Is Refund"),
    F_("duration_streamed", "comma_float", "Duration Streamed"),
    F_("paid_ad_impressions", "comma_float", "Paid Ad Impressions"),
    F_("ad_revenue", "comma_float", "Ad Revenue"),
    F_("royalty_rate", "comma_float", "Royalty Rate"),
    F_("royalty_amount", "comma_float", "Royalty Amount"),
    F_("royalty_currency", "text", "Royalty Currency"),
    F_("region", "text", "Region"),
    F_("territory", "text", "Territory"),
    F_("type", "text", "Type"),
    F_("cer_percentile", "percent", "CER Percentile"),
), Period("row_pair", ("Period Start", "Period End"), "yyyy-MM-dd"), constants=("report_type",))

REVENUE_V4 = LoadSpec("revenue_v4", (
    F_("upc", "text", "UPC"),
    F_("isrc_or_isbn", "text", "ISRC/ISBNP"),
    F_("vendor_identifier", "text", "Vendor Identifier"),
    F_("quantity", "int", "Quantity"),
    F_("partner_share", "float", "Partner Share"),
    F_("extended_partner_share", "float", "Extended Partner Share"),
    F_("partner_share_currency", "text", "Partner Share Currency", "Parner Share Currency"),
    F_("sales_or_return", "text", "Sales or Return"),
    F_("apple_identifier", "bigint", "Apple Identifier"),
    F_("show_or_developer", "text", "Artist/Show/Developer/Author"),
    F_("title", "text", "Title"),
    F_("studio_or_network", "text", "Label/Studio/Network/Developer/Publisher"),
    F_("grid", "text", "Grid"),
    F_("product_type_identifier", "text", "Product Type Identifier"),
    F_("isan_or_other_identifier", "text", "ISAN/Other Identifier"),
    F_("country_of_sale", "text", "Country of Sale"),
    F_("preorder_flag", "text", "Pre-order Flag"),
    F_("promo_code", "text", "Promo Code"),
    F_("customer_price", "float", "Customer Price"),
    F_("customer_currency", "text", "Customer Currency"),
), Period("row_ts_pair", ("Start Date", "End Date")))

MONETIZATION_V5 = LoadSpec("monetization_v5", (
    F_("content_partner", "text", "Content Partner"),
    F_("itemset_name", "text", "ItemSet Name"),
    F_("item_name", "text", "Item Name"),
    F_("clip_name", "text", "Clip Name"),
    F_("tvms", "int", "TVMs"),
    F_("sessions", "int", "Sessions"),
    F_("revenue_per_clip", "float", "Revenue per Clip"),
), Period("sheet_month", ("sheet",)))

FINANCE_V6 = LoadSpec("finance_v6", (
    F_("payout", "float", "Payout"),
    F_("provider", "text", "ProviderName"),
    F_("country", "text", "Territory"),
    F_("title_name", "text", "Title"),
), Period("file_quarter"))

REVENUE_V7 = LoadSpec("revenue_v7", (
    F_("programmer", "text", "Programmer"),
    F_("channel", "text", "Channel"),
    F_("asset_title", "text", "asset_title"),
    F_("asset_program_name", "text", "asset_program_name"),
    F_("total_unique_users", "int", "Total Unique Users"),
    F_("total_item_start", "int", "Total Item Start"),
    F_("total_item_complete", "int", "Total Item Complete"),
    F_("share_of_monthly_total", "float", "Share of Monthly Total", "Share of Monethly Total"),
    F_("implied_revenue", "float", "Implied Revenue"),
), Period("row_ts_month", ("Report Month",)))

CATALOGUE_ITEMS = LoadSpec("catalogue_items", (
    F_("item_id", "text", "item_id"),
    F_("show_id", "text", "show_id"),
    F_("title", "text", "title"),
    F_("item_image_url", "text", "item_image_url"),
    F_("overview", "text", "overview"),
    F_("runtime", "number?", "runtime"),
    F_("sequence_number", "text", "sequence_number"),
    F_("item_number", "text", "item_number"),
    F_("released_on", "timestamp?", "released_on"),
    F_("external_id", "text", "DataSource2"),
    F_("source_filename", "text", "source_filename"),
), audit=CATALOGUE_AUDIT)

CATALOGUE_SHOWS = LoadSpec("catalogue_shows", (
    F_("show_id", "text", "show_id"),
    F_("title", "text", "title"),
    F_("poster_url", "text", "poster_url"),
    F_("backdrop_url", "text", "backdrop_url"),
    F_("overview", "text", "overview"),
    F_("show_cast", "array", "show_cast"),
    F_("popularity", "decimal(10,5)?", "popularity"),
    F_("classification", "text", "classification"),
    F_("runtime", "number?", "runtime"),
    F_("genres", "array", "genres"),
    F_("tags", "array", "tags"),
    F_("released_on", "date?", "released_on"),
    F_("vendor2_url", "text", "vendor2_url"),
    F_("status", "text", "status"),
    F_("production_company", "array", "production_company"),
    F_("trailer_url", "array", "trailer_url"),
    F_("network", "array", "network"),
    F_("language", "text", "language"),
    F_("external_id", "text", "DataSource2"),
    F_("source_filename", "text", "source_filename"),
), audit=CATALOGUE_AUDIT)

CATALOGUE_SOURCES = LoadSpec("catalogue_sources", (
    F_("access_type", "number?", "access_type"),
    F_("display_name", "text", "display_name"),
    F_("id", "text", "id"),
    F_("source_name", "text", "source_name"),
    F_("source_filename", "text", "source_filename"),
    F_("report_ts", "timestamp", "report_ts"),
), audit=CATALOGUE_AUDIT)

CATALOGUE_ITEM_SOURCES = LoadSpec("catalogue_item_sources", (
    F_("item_id", "text", "item_id"),
    F_("purchase_cost_hd", "text", "purchase_cost_hd"),
    F_("purchase_cost_sd", "text", "purchase_cost_sd"),
    F_("region_id", "text", "region_id"),
    F_("rental_cost_hd", "text", "rental_cost_hd"),
    F_("rental_cost_sd", "text", "rental_cost_sd"),
    F_("source_id", "text", "source_id"),
    F_("source_filename", "text", "source_filename"),
    F_("report_ts", "timestamp", "report_ts"),
), audit=CATALOGUE_AUDIT)

CATALOGUE_AVAILABILITY = LoadSpec("catalogue_availability", (
    F_("item_id", "text", "item_id"),
    F_("region_id", "text", "region_id"),
    F_("service_availability", "array", "service_availability"),
    F_("source_filename", "text", "source_filename"),
    F_("report_ts", "timestamp", "report_ts"),
), audit=CATALOGUE_AUDIT)

# job id -> spec
SPECS = {
    "c4": ASSET_REPORT, "c5": BASIC_METRICS, "c6": DEMOGRAPHICS, "c7": DEVICE_TYPE,
    "c8": TRAFFIC_SOURCE, "c9": FINANCE, "c10": REVENUE_V3, "c11": REVENUE_V4,
    "c12": MONETIZATION_V5, "c13": FINANCE_V6, "c14": REVENUE_V7, "c15": CATALOGUE_ITEMS,
    "c16": CATALOGUE_SHOWS, "c17": CATALOGUE_SOURCES, "c18": CATALOGUE_ITEM_SOURCES,
    "c19": CATALOGUE_AVAILABILITY,
}

# report folder name -> spec, for choosing by path (P10)
BY_REPORT = {s.name: s for s in SPECS.values()}
