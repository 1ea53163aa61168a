"""Constants of the reference views that the results depend on.

Fixed values (as stated in the reference views):
"""

LOG_STORAGE_PRICE_PER_100MB = 0.005     # log table cost per 100 MB
HEARTBEATS_PER_DAY = 288                # one heartbeat per 5 minutes
NOISY_CALLS_PER_DAY = 480               # a display above this many calls a day is noisy
NOISY_CALLS_PER_HOUR = 20               # today's threshold: 20 x (hour + 1)
DATASTORE_FREE_TIER = 50000             # free gets / puts per day
DATASTORE_PRICE_PER_100K = 0.6          # price per 100,000 gets / puts above the free tier
PUTS_PER_DISPLAY_REQUEST = 2            # datastore puts per display request
REINDEX_PER_DISPLAY_REQUEST = 3         # reindex operations per display request
REINDEX_PER_CHANNEL_UPDATE = 5          # reindex operations per channel update
INSTANCE_HOUR_PRICE = 0.2               # price per instance hour
TOP_ERROR_DETAIL_LENGTH = 200           # error details are grouped by their first 200 characters
WEEKLY_METRICS_ROWS = 1000              # newest weeks listed by the weekly metrics view
# fixed byte widths of the log row's fixed-size fields, in the view's field order
LOG_ROW_FIXED_BYTES = {"ts": 8, "platform": 11, "source": 25, "version": 18, "rollout_stage": 8,
                       "display_id": 14, "company_id": 38, "level": 9, "player.version": 18}
