"""Outputs of one earlier run that the library must match."""

# Predictions and the chosen team of that run, in their order.
PREDICTIONS = """\
player_id,fp_pred,team_id,role,prediction_confidence,credits,predicted_rank,percentile,variance_category
34102,85.245895,1,Top-order,0.7981144,12.0,1,100.0,High Variance
253802,76.57051,2,Top-order,0.7938953,11.91891891891892,2,97.2972972972973,High Variance
1350792,66.21235,2,Bowler,0.7760015,11.737837837837839,3,94.5945945945946,High Variance
605661,64.30648,1,Wicketkeeper-batsman,0.7694082,12.256756756756758,4,91.89189189189189,High Variance
677077,62.458744,2,All-rounder,0.7614679,12.375675675675675,5,89.1891891891892,Above Average
1119026,62.169106,2,Top-order,0.7600675,11.594594594594595,6,86.48648648648648,Above Average
955235,59.045403,2,Bowler,0.74189514,11.413513513513514,7,83.78378378378379,Above Average
326016,57.419113,2,Bowler,0.729967,11.332432432432432,8,81.08108108108108,Above Average
30288,56.713173,1,All-rounder,0.7242183,12.05135135135135,9,78.37837837837837,Above Average
471342,53.307503,2,All-rounder,0.69149154,11.97027027027027,10,75.67567567567568,Above Average
897549,52.734333,1,Batter,0.68518865,11.18918918918919,11,72.97297297297297,Average
297433,52.205627,1,Wicketkeeper-batsman,0.679185,11.608108108108109,12,70.27027027027026,Average
892749,51.20239,2,Middle-order,0.6673215,11.027027027027028,13,67.56756756756756,Average
625383,50.848415,1,Bowler,0.66299826,10.845945945945946,14,64.86486486486487,Average
669365,50.817554,2,Wicketkeeper-batsman,0.6626181,11.364864864864865,15,62.16216216216216,Average
1350762,50.75838,1,Wicketkeeper-batsman,0.6618879,11.283783783783784,16,59.45945945945945,Average
288284,49.74638,2,Bowler,0.6491306,10.562162162162162,17,56.75675675675676,Average
288284,49.74638,2,Bowler,0.6491306,10.562162162162162,18,54.054054054054056,Average
1161489,47.283504,2,Bowler,0.61646426,10.44054054054054,19,51.35135135135135,Average
625371,43.022003,1,All-rounder,0.6411357,11.159459459459459,20,48.64864864864865,Below Average
1159720,41.98568,2,Bowler,0.6544811,10.27837837837838,21,45.945945945945944,Below Average
398438,41.5148,2,Batter,0.6603843,10.297297297297298,22,43.24324324324324,Below Average
277912,37.96319,1,Bowler,0.7007461,10.116216216216216,23,40.54054054054054,Below Average
446507,36.92967,1,Batter,0.71090704,10.135135135135135,24,37.83783783783784,Below Average
447261,36.21003,1,Bowler,0.71753085,9.954054054054055,25,35.13513513513513,Below Average
823703,35.72711,2,Top-order,0.7217673,9.972972972972974,26,32.432432432432435,Below Average
542023,35.195633,2,Bowler,0.72623694,9.791891891891892,27,29.729729729729726,Below Average
1392201,34.305824,1,Bowler,0.73327327,9.71081081081081,28,27.027027027027028,Below Average
403902,33.621506,2,Batter,0.7383114,9.72972972972973,29,24.32432432432432,Low Variance
502714,32.57534,1,All-rounder,0.7454073,10.348648648648648,30,21.62162162162162,Low Variance
594322,31.700598,1,All-rounder,0.75080144,10.267567567567568,31,18.918918918918916,Low Variance
1287032,31.376633,1,Top-order,0.7526798,9.486486486486486,32,16.216216216216218,Low Variance
1292502,30.289732,1,All-rounder,0.7585339,10.105405405405405,33,13.513513513513509,Low Variance
1194959,27.812618,2,Batter,0.76953423,9.283783783783784,34,10.81081081081081,Low Variance
1057399,27.812618,2,All-rounder,0.76953423,9.983783783783784,35,8.108108108108103,Low Variance
721867,25.775757,2,Wicketkeeper-batsman,0.77650124,9.662162162162161,36,5.405405405405405,Low Variance
1170265,22.198647,1,Batter,0.78525186,9.08108108108108,37,2.7027027027026973,Low Variance
"""

TEAM = """\
player_id,fp_pred,team_id,prediction_confidence,starting_probability,role_std,captain_score,captain,vice_captain
253802,76.57051,2,0.7938953,1.0,Batter,60.788969015561634,True,False
605661,64.30648,1,0.7694082,1.0,Wicketkeeper,49.477935011651425,False,True
1119026,62.169106,2,0.7600675,1.0,Batter,47.25271801766803,False,False
34102,85.245895,1,0.7981144,0.6666666666666666,Batter,45.35731884434426,False,False
471342,53.307503,2,0.69149154,1.0,Allrounder,36.8616873941678,False,False
1350792,66.21235,2,0.7760015,0.6666666666666666,Bowler,34.25392197029851,False,False
892749,51.20239,2,0.6673215,1.0,Batter,34.16845503511536,False,False
669365,50.817554,2,0.6626181,1.0,Wicketkeeper,33.67263142481056,False,False
288284,49.74638,2,0.6491306,1.0,Bowler,32.291896546180396,False,False
625371,43.022003,1,0.6411357,1.0,Allrounder,27.582941801738343,False,False
277912,37.96319,1,0.7007461,1.0,Bowler,26.602556776815163,False,False
"""
