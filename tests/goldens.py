"""Expected pane and attribution strings of the published examples."""


GOLDEN = {
    "2-1": ["[global window]: TeamX:48 END_OF_GLOBAL_WINDOW ON_TIME index=0 onTimeIndex=0 isFirst isLast"],
    "2-2": ["[12:00:00, 12:02:00): TeamX:14 12:01:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
            "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
            "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
            "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast"],
    "2-3": ["[12:00:00, 12:02:00): TeamX:5  12:01:59 EARLY   index=0 isFirst",
            "[12:00:00, 12:02:00): TeamX:14 12:01:59 EARLY   index=1",
            "[12:02:00, 12:04:00): TeamX:7  12:03:59 EARLY   index=0 isFirst",
            "[12:02:00, 12:04:00): TeamX:10 12:03:59 EARLY   index=1",
            "[12:02:00, 12:04:00): TeamX:18 12:03:59 EARLY   index=2",
            "[12:04:00, 12:06:00): TeamX:4  12:05:59 EARLY   index=0 isFirst",
            "[12:06:00, 12:08:00): TeamX:3  12:07:59 EARLY   index=0 isFirst",
            "[12:06:00, 12:08:00): TeamX:11 12:07:59 EARLY   index=1",
            "[12:06:00, 12:08:00): TeamX:12 12:07:59 EARLY   index=2"],
    "2-5": ["[12:00:00, 12:02:00): TeamX:5  12:01:59 EARLY   index=0 isFirst",
            "[12:00:00, 12:02:00): TeamX:14 12:01:59 ON_TIME index=1 onTimeIndex=0 isLast",
            "[12:02:00, 12:04:00): TeamX:18 12:03:59 EARLY   index=0 isFirst",
            "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=1 onTimeIndex=0 isLast",
            "[12:04:00, 12:06:00): TeamX:4  12:05:59 EARLY   index=0 isFirst",
            "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=1 onTimeIndex=0 isLast",
            "[12:06:00, 12:08:00): TeamX:12 12:07:59 EARLY   index=0 isFirst",
            "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=1 onTimeIndex=0 isLast"],
    "2-6left": ["[12:00:00, 12:02:00): TeamX:14 12:01:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast"],
    "2-6right": ["[12:00:00, 12:02:00): TeamX:5  12:01:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=0 onTimeIndex=0 isFirst isLast"],
    "2-7left": ["[12:00:00, 12:02:00): TeamX:5  12:01:59 EARLY   index=0 isFirst",
                "[12:00:00, 12:02:00): TeamX:14 12:01:59 ON_TIME index=1 onTimeIndex=0",
                "[12:02:00, 12:04:00): TeamX:10 12:03:59 EARLY   index=0 isFirst",
                "[12:02:00, 12:04:00): TeamX:18 12:03:59 EARLY   index=1",
                "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=2 onTimeIndex=0",
                "[12:04:00, 12:06:00): TeamX:4  12:05:59 EARLY   index=0 isFirst",
                "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=1 onTimeIndex=0",
                "[12:06:00, 12:08:00): TeamX:3  12:07:59 EARLY   index=0 isFirst",
                "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=1 onTimeIndex=0"],
    "2-7right": ["[12:00:00, 12:02:00): TeamX:5  12:01:59 EARLY   index=0 isFirst",
                 "[12:00:00, 12:02:00): TeamX:5  12:01:59 ON_TIME index=1 onTimeIndex=0",
                 "[12:00:00, 12:02:00): TeamX:14 12:01:59 LATE    index=2 onTimeIndex=1",
                 "[12:02:00, 12:04:00): TeamX:10 12:03:59 EARLY   index=0 isFirst",
                 "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=1 onTimeIndex=0",
                 "[12:04:00, 12:06:00): TeamX:4  12:05:59 EARLY   index=0 isFirst",
                 "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=1 onTimeIndex=0",
                 "[12:06:00, 12:08:00): TeamX:3  12:07:59 EARLY   index=0 isFirst",
                 "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=1 onTimeIndex=0"],
    "2-8": ["[12:00:00, 12:02:00): TeamX:5  12:01:59 EARLY   index=0 isFirst",
            "[12:00:00, 12:02:00): TeamX:5  12:01:59 ON_TIME index=1 onTimeIndex=0",
            "[12:00:00, 12:02:00): TeamX:11 12:01:59 LATE    index=2 onTimeIndex=1",
            "[12:02:00, 12:04:00): TeamX:10 12:03:59 EARLY   index=0 isFirst",
            "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=1 onTimeIndex=0",
            "[12:04:00, 12:06:00): TeamX:4  12:05:59 EARLY   index=0 isFirst",
            "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=1 onTimeIndex=0",
            "[12:06:00, 12:08:00): TeamX:3  12:07:59 EARLY   index=0 isFirst",
            "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=1 onTimeIndex=0"],
    "2-9": ["[12:00:00, 12:02:00): TeamX:5  12:01:59 EARLY   index=0 isFirst",
            "[12:00:00, 12:02:00): TeamX:0  12:01:59 ON_TIME index=1 onTimeIndex=0",
            "[12:00:00, 12:02:00): TeamX:9  12:01:59 LATE    index=2 onTimeIndex=1",
            "[12:02:00, 12:04:00): TeamX:10 12:03:59 EARLY   index=0 isFirst",
            "[12:02:00, 12:04:00): TeamX:8  12:03:59 ON_TIME index=1 onTimeIndex=0",
            "[12:04:00, 12:06:00): TeamX:4  12:05:59 EARLY   index=0 isFirst",
            "[12:04:00, 12:06:00): TeamX:0  12:05:59 ON_TIME index=1 onTimeIndex=0",
            "[12:06:00, 12:08:00): TeamX:3  12:07:59 EARLY   index=0 isFirst",
            "[12:06:00, 12:08:00): TeamX:9  12:07:59 ON_TIME index=1 onTimeIndex=0"],
    "4-3": ["[12:00:26, 12:01:26): TeamX:5  12:01:25 EARLY   index=0 isFirst",
            "[12:00:26, 12:01:26): TeamX:5  12:01:25 ON_TIME index=1 onTimeIndex=0",
            "[12:02:24, 12:03:24): TeamX:7  12:03:23 EARLY   index=0 isFirst",
            "[12:02:24, 12:05:19): TeamX:22 12:05:18 EARLY   index=0 isFirst",
            "[12:02:24, 12:05:19): TeamX:22 12:05:18 ON_TIME index=1 onTimeIndex=0",
            "[12:00:26, 12:05:19): TeamX:36 12:05:18 LATE    index=0 onTimeIndex=0 isFirst",
            "[12:06:39, 12:07:39): TeamX:3  12:07:38 EARLY   index=0 isFirst",
            "[12:06:39, 12:08:46): TeamX:12 12:08:45 EARLY   index=0 isFirst",
            "[12:06:39, 12:08:46): TeamX:12 12:08:45 ON_TIME index=1 onTimeIndex=0 isLast"],
    "validity": ["[12:00:26, 12:01:25): TeamX:5  12:01:24 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:01:25, 12:02:24): TeamX:9  12:02:23 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:02:24, 12:03:06): TeamX:7  12:03:05 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:03:06, 12:03:39): TeamX:8  12:03:38 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:03:39, 12:04:19): TeamX:3  12:04:18 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:04:19, 12:06:39): TeamX:4  12:06:38 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:06:39, 12:07:26): TeamX:3  12:07:25 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:07:26, 12:07:46): TeamX:8  12:07:45 ON_TIME index=0 onTimeIndex=0 isFirst isLast",
                 "[12:07:46, END_OF_GLOBAL_WINDOW): TeamX:1  04:00:54 ON_TIME index=0 onTimeIndex=0 isFirst isLast"],
    "attribution": [
        "[global window]: imp=123 http://search.com?q=xyz → http://xyz.com/ → http://xyz.com/join-mailing-list "
        "12:01:30 UNKNOWN",
        "[global window]: imp=456 http://search.com?q=thing → http://xyz.com/thing → http://xyz.com/thing/add-to-cart"
        " → http://xyz.com/thing/purchase → http://xyz.com/thing/receipt 12:03:45 UNKNOWN"],
}

# Aligned delay (period 2 minutes, aligned to 12:05) derived from the trigger rules
# rather than taken from the published example, whose author flags it as unreliable.
ALIGNED_OURS = ["[12:00:00, 12:02:00): TeamX:5  12:01:59 EARLY   index=0 isFirst",
                "[12:00:00, 12:02:00): TeamX:14 12:01:59 EARLY   index=1",
                "[12:00:00, 12:02:00): TeamX:14 12:01:59 ON_TIME index=2 onTimeIndex=0 isLast",
                "[12:02:00, 12:04:00): TeamX:10 12:03:59 EARLY   index=0 isFirst",
                "[12:02:00, 12:04:00): TeamX:18 12:03:59 EARLY   index=1",
                "[12:02:00, 12:04:00): TeamX:18 12:03:59 ON_TIME index=2 onTimeIndex=0 isLast",
                "[12:04:00, 12:06:00): TeamX:4  12:05:59 EARLY   index=0 isFirst",
                "[12:04:00, 12:06:00): TeamX:4  12:05:59 ON_TIME index=1 onTimeIndex=0 isLast",
                "[12:06:00, 12:08:00): TeamX:11 12:07:59 EARLY   index=0 isFirst",
                "[12:06:00, 12:08:00): TeamX:12 12:07:59 EARLY   index=1",
                "[12:06:00, 12:08:00): TeamX:12 12:07:59 ON_TIME index=2 onTimeIndex=0 isLast"]

# The score lines of the batch job's input file.
SCORE_CSV = """Julie,\tTeamX, 5, T12:00:26, 12:05:19
Ed,\tTeamX, 7, T12:02:26, 12:05:39
Amy,\tTeamX, 3, T12:03:39, 12:06:13
Fred,\tTeamX, 4, T12:04:19, 12:06:39
Julie,\tTeamX, 8, T12:03:06, 12:07:06
Naomi,\tTeamX, 3, T12:06:39, 12:07:19
Frank,\tTeamX, 9, T12:01:26, 12:08:19
Becky,\tTeamX, 8, T12:07:26, 12:08:39
Naomi,\tTeamX, 1, T12:07:46, 12:09:00
"""
