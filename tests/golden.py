"""The published segmentation of 23 pharmacies: inputs, segment rank and components."""

# One pharmacy per line.
COLUMNS = """
PharmacyID TotalSalesAmount TotalQuantity NumberOfTransactions AvgTransactionAmount ProductVariety ManufacturerVariety BrandVariety MonthlySalesIntensity
BrandedSalesAmount GenericSalesAmount BrandedSalesShare GenericSalesShare ActiveMonths RecencyDays SegmentRank PCA1 PCA2
""".split()

ROWS = """
5 6556489.50 136891.00 45689 143.50 66 18 61 156106.89 6355168.75 201320.75 0.9693 0.0307 42 0 1 10.489332 -0.204401
20 585531.80 138684.00 46045 12.72 66 18 61 13941.23 369067.00 216464.80 0.6303 0.3697 42 0 2 -0.399574 3.022901
21 584211.17 138477.00 46215 12.64 66 18 61 13909.79 372508.02 211703.15 0.6376 0.3624 42 0 2 -0.272922 3.324190
19 574346.11 137569.00 45849 12.53 66 18 61 13674.91 363710.58 210635.53 0.6333 0.3667 42 0 2 -0.442847 1.441023
10 563280.50 137625.00 45824 12.29 66 18 61 13411.44 360288.30 202992.20 0.6396 0.3604 42 0 2 -0.375208 1.414661
1 552276.79 137879.00 45872 12.04 66 18 61 13149.45 352405.94 199870.85 0.6381 0.3619 42 0 2 -0.390733 1.786117
22 573961.20 135760.00 45423 12.64 66 18 61 13665.74 365558.56 208402.64 0.6369 0.3631 42 0 3 -0.532051 -1.439593
23 573779.57 135559.00 45337 12.66 66 18 61 13661.42 366609.33 207170.24 0.6389 0.3611 42 0 3 -0.529058 -1.873379
17 571585.97 136641.00 45527 12.55 66 18 61 13609.19 365718.78 205867.19 0.6398 0.3602 42 0 3 -0.451946 -0.341152
16 568443.92 136662.00 45587 12.47 66 18 61 13534.38 365402.20 203041.72 0.6428 0.3572 42 0 3 -0.402634 -0.149777
18 566705.68 135676.00 45117 12.56 66 18 61 13492.99 358524.04 208181.64 0.6326 0.3674 42 0 3 -0.664498 -2.401989
14 566538.48 136932.00 45658 12.41 66 18 61 13489.01 363077.20 203461.28 0.6409 0.3591 42 0 3 -0.408269 0.302926
15 566447.35 136789.00 45585 12.43 66 18 61 13486.84 362422.10 204025.25 0.6398 0.3602 42 0 3 -0.441581 -0.038113
13 563827.96 137092.00 45630 12.36 66 18 61 13424.48 360339.28 203488.68 0.6391 0.3609 42 0 3 -0.436759 0.367955
12 561944.60 136530.00 45470 12.36 66 18 61 13379.63 354391.96 207552.64 0.6307 0.3693 42 0 3 -0.598476 -0.599865
11 560118.93 136463.00 45610 12.28 66 18 61 13336.17 358068.43 202050.50 0.6393 0.3607 42 0 3 -0.458266 -0.259988
9 558373.72 136608.00 45438 12.29 66 18 61 13294.61 357662.37 200711.35 0.6405 0.3595 42 0 3 -0.477197 -0.629776
6 557958.02 137167.00 45605 12.23 66 18 61 13284.71 354687.72 203270.30 0.6357 0.3643 42 0 3 -0.491621 0.366134
8 557619.96 136537.00 45477 12.26 66 18 61 13276.67 355917.88 201702.08 0.6383 0.3617 42 0 3 -0.501101 -0.578871
4 556228.76 136894.00 45463 12.23 66 18 61 13243.54 352664.56 203564.20 0.6340 0.3660 42 0 3 -0.552895 -0.292799
7 553169.78 136154.00 45426 12.18 66 18 61 13170.71 351943.53 201226.25 0.6362 0.3638 42 0 3 -0.553444 -1.072349
3 551492.25 136475.00 45447 12.13 66 18 61 13130.77 350035.33 201456.92 0.6347 0.3653 42 0 3 -0.562928 -0.719201
2 550071.92 136246.00 45277 12.15 66 18 61 13096.95 351709.98 198361.94 0.6394 0.3606 42 0 3 -0.545324 -1.424655
"""

GOLDEN = [dict(zip(COLUMNS, map(float, line.split()))) for line in ROWS.strip().splitlines()]
