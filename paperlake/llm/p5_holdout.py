"""Examples of the four kinds, written and labelled by hand. They calibrate and test the model and train nothing."""

PROSE = [
    "The rover stopped at the rim because the battery was low. After two hours it moved on, and the crew saw no fault.",
    "Results\n\nWe tested the planner in a cold room for nine days\nand it did not fail, although the second unit\nwas replaced before the last run.",
    "Le satellite a perdu le contact pendant une heure, mais les mesures sont restées dans la mémoire du bord.",
    "Der Rechner wurde nach dem Test neu gestartet, und die Werte waren wieder da. Es gab keine weiteren Fehler.",
    "El equipo midió la precisión del sensor durante la noche y no encontró cambios en los datos.",
    "Once the map is loaded the drone needs no help from the ground. Three of the limits were:\n- wind\n- dust\nAll of them were known before the flight and did not change the plan that was made by the team.",
    "It was not clear to us why the second arm had moved first. The log showed two commands with the same time, and the one from the ground was the later of the two.",
    "A short note on the new valve: it opens at 3 bar, it closes at 2.5 bar, and it has done so in each of the 40 trials that we have run since May.",
    "We would like to thank the people who kept the chamber cold for the whole of the winter, and those who read the first version of this text.",
    "If the dust is thick the camera can not see the wheel.\nIf the wheel slips the planner has to know about it,\nand so we ask the motor for its current.",
    "The cost of each run is shown below.\n4.2;3;11\n5.1;2;10\nAs can be seen from these values the second run was the cheaper one, but it took more time than had been planned for it, and for that reason we did not use it again in the tests of the year.",
    "Nothing in this report should be read as a promise. The figures are those of one flight, and a second flight may well give other ones.",
    "La nuit suivante, le robot est revenu par le même chemin et il a retrouvé la balise que nous avions posée sur le sol.",
    "Dans ce cas le calcul est plus long, mais il donne une route plus sûre pour le véhicule et pour ceux qui le suivent.",
    "Am Abend war der Sand so weich, dass die Räder sich nicht mehr drehten. Wir haben deshalb bis zum Morgen gewartet.",
    "Die Karte zeigt, wo das Fahrzeug stand und welche Wege es nicht nehmen konnte, weil dort zu viele Steine lagen.",
    "Por la mañana el viento era fuerte y la antena no estaba en su sitio, por lo que tuvimos que esperar hasta la tarde.",
    "No se sabe si el fallo fue del motor o de la orden que se le dio, pero en los dos casos el resultado es el mismo.",
    "INTRODUCTION\n\nThis paper is about what a machine does when it can not ask. There is no one to tell it where the stones are, and it has to find that out by itself.",
    "She wrote that the test had gone well. He wrote back that it had not, and sent the two plots to show what he meant by that.",
    "With the old filter the error was 12 m after one hour; with the new one it was 3 m. We do not think that this is due to the weather.",
    "First the tank is filled. Then the pump is started, and when the pressure is at the mark the valve may be opened by hand. It must not be opened before that.",
    "Who is to decide when the link is down? In our view it is the system on board, as long as it can show later on what it knew and why it did what it did.",
    "The samples\nwere kept in\na cold box\nuntil they were\nneeded, and they\ndid not change\nin that time.",
    "Two teams have looked into this. The first used a net that was trained on images from the desert (see Section 4), the second one used rules, and both came to much the same result on the data of the last year.",
    "At 10:32 the unit was at 41 C and at 10:40 it was at 55 C, so it was shut off by the crew before it could get any hotter than that.",
    "There were 3 faults in 2019, 5 in 2020 and none in 2021. We put this down to the new cables, which had been in use from the start of that year.",
    "A planner that is too careful will not get far. One that is not careful enough will get stuck, and then it does not matter how fast it was.",
    "What follows is the text of the letter as it was sent to us, with no change but for the names, which have been left out here.",
    "The arm has six joints. Each of them has a motor, a brake and a sensor for its angle, and all of these are read ten times in a second by the same board.",
]

LIST = [
    "- front wheel\n- rear wheel, 3 off\n- mast camera\n- drill head\n- battery heater",
    "1. star tracker\n2. sun sensor (coarse)\n3. gyro unit\n4. reaction wheel\n5. torque rod",
    "[1] A. Novak, Planning on slopes, vol. 3, pp. 10-22, 2011\n[2] B. Stone, A camera for dust, vol. 7, pp. 91-99, 2014\n[3] C. Ray, Wheels, vol. 1, pp. 5-9, 2001",
    "map server, path planner, dust filter, star tracker\nwheel model, arm model, slip model\ntask queue, fault log, heater",
    "Rover wheel\nRover arm\nOrbital relay\nDrill motor / spare\nThermal switch, 4 off",
    "Planner AX: adaptive route checker\nSensor BD: bounded dust filter\nController QT: modular arm drive",
    "* open the valve\n* read the pressure\n* close the valve\n* write it down",
    "a) camera\nb) radio\nc) heater\nd) clock\ne) tank",
    "antenna, battery, camera, drill, encoder, filter, gyro, heater, inverter, joint, kernel, lens, motor",
    "Checklist\n1) power on\n2) link test\n3) load plan\n4) arm brake\n5) start run",
    "• Thermal model\n• Power model\n• Link model\n• Dust model\n• Fault tree",
    "(1) rear camera, left\n(2) rear camera, right\n(3) front camera\n(4) mast camera, 2 off",
    "Smith, J. Wheels on sand. Rover Letters 4, 11-19, 2008.\nNovak, A. Slopes and stones. Field Notes 9, 1-8, 2013.\nRay, C. Cold starts. Power Review 2, 77-80, 2004.",
    "battery\nbattery heater\nbattery switch\nsolar panel\nsolar panel drive\nbus converter",
    "– roue avant\n– roue arrière\n– caméra du mât\n– antenne\n– foreuse",
    "1. Bohrer\n2. Kamera\n3. Antenne\n4. Heizung\n5. Batterie\n6. Rechner",
    "- cámara frontal\n- antena plana\n- motor del brazo\n- rueda trasera\n- sensor solar",
    "path planner; task planner; arm planner\nslip estimator; pose estimator\nfault monitor; health monitor",
    "[12] P. Grey, Maps for caves, Proc. Field Robots, pp. 4-9, 2016\n[13] R. Hall, Loops, Proc. Field Robots, pp. 30-41, 2017\n[14] T. Moor, Ropes, Proc. Descent, pp. 2-3, 2019",
    "Estimator: slip, pose\nFilter: dust, glare\nPlanner: route, task\nMonitor: power, heat",
    "10. pump\n11. valve\n12. tank\n13. gauge\n14. hose\n15. clamp, 2 off",
    "Required parts\n- bolt M4, 12 off\n- washer, 12 off\n- plate\n- cable tie, 6 off",
    "autonomy, planning, rover navigation, visual odometry, fault detection, onboard scheduling, constraint solving",
    "- read mast camera\n- read wheel current\n- store slip value\n- send short report",
]

TABLE = [
    "speed;slope;load\n12;4;88\n9;n/a;71\n10.5;3;90\n-;2;66",
    "a | b | c\n---+---+---\n1 | 2 | 3\n4 | 5.5 | n/a\n7 | ok | 9",
    "run=1  ab=33  cd=ok\nrun=2  ef=4.5  gh=90\nrun=3  xx=-  ab=7",
    "12   44.1   9\n3   -   18\n77   5   n/a\n1   20   31",
    "depth\tspeed\trate\n1.2\t33\t9\n4\t-\t18\n9\t12\t7",
    "1,44,0.3\n2,51,0.2\n3,48,0.9\n4,47,0.1\n5,50,0.4",
    "| run | temp | ok |\n| 1 | 44.2 | yes |\n| 2 | 45.0 | no |\n| 3 | 43.1 | yes |",
    "day;min;max;mean\n1;-40;2;-19\n2;-41;1;-20\n3;-38;4;-17",
    "t   v   a\n0.0   0   1.1\n0.1   0.11   1.0\n0.2   0.21   1.0\n0.3   0.30   0.9",
    "run=11  time=4.2  fault=no\nrun=12  time=4.9  fault=no\nrun=13  time=7.7  fault=yes",
    "2001\t14\t3%\n2002\t19\t4%\n2003\t11\t2%\n2004\t25\t6%",
    "x | y | z\n0.1 | 0.4 | 9\n0.2 | 0.3 | 8\n0.3 | 0.1 | 8\n0.4 | 0.0 | 7",
    "axis;ABC;DEF\n1;3.3;9\n2;4.1;n/a\n3;-;7\n4;2.2;5",
    "11  12  13  14\n21  22  23  24\n31  32  33  34\n41  42  43  44",
    "slip_rate;path_length;energy_used\n0.1;120;44\n0.3;98;51\n0.2;101;47",
    "1\t-3\t5.5\n2\t-2\t5.1\n3\t-1\t4.9\n4\t0\t4.8",
    "id,ok,ms\n4,yes,12\n5,yes,15\n6,no,90\n7,yes,11",
    "ab=1  cd=2  ef=3\nab=4  cd=5  ef=6\nab=7  cd=8  ef=9",
    "k | n\n--+--\n1 | 10\n2 | 44\n3 | 97\n4 | 201\n5 | 388",
    "0.5;0.25;0.125\n0.4;0.16;0.064\n0.3;0.09;0.027\n0.2;0.04;0.008",
]

JUNK = [
    "q8ZrT0aLw+vX/93kdPPo2mJHs\nZx81/ppQwe+Lk22TTyuAAbcV\nmmN0pqR5stUvWx+yz//abQ",
    "9f3a 11bc e07d 4421\n77aa 0c1d fe92 83b0\n1029 ab4e cc01 9d8f",
    "zxqv bnrt wlkp zxqv bnrt wlkp zxqv bnrt wlkp\nzxqv bnrt wlkp zxqv bnrt wlkp",
    "=;]=*%;|#;&+^||*+~{_*~\n[&_+_;=>#|}:<#;<%;|^~\n{}#*}<{+}>_}{+*~~<]=|",
    "©Ã¢ â£ ™ð¥ Ðâ ¢ð€©© ¥£Ÿâ¢ Ñ£ÑŸ\nð€Â¥ âÐ© Ÿ£Ã ¢ÑÐ ™™€",
    "brwqk xznfp ogtrl vvbe qpslk wjrnt mmz\nplokq wrtzx nvbce qqwr kjhgf dsapo",
    "%%%%% $$$$ ### @@@@ ^^^^^ &&&& ****\n((((( )))) ==== ++++ ???? !!!!",
    "Hk3jd9sKLq02mXncBv84jdLQpwoei\nZmxn10293847qpwoeirutyLAKSJDH\nfgh/BVNCMX+woqpei==",
    "xq zw vk jj qx zzk wv qj xk zv qw jx\nvz qk xj wq zx kv jq wz xv qz kx jw",
    "0x3f 0x9a 0x00 0x1c 0xff 0x7e 0x21\n0xb2 0x4d 0x90 0x08 0xe1 0x55 0x6a",
    "ÃÂ¢ÃÂ¯ ÂÃ© Ã¼Â ÃÂ ÂÂÂ Ã¶Ã\nÂ£ÃÂ¥ ÃÃÂ Â¤Ã¸ ÃÂÂ Ã±Â",
    "~~##~~ |||| ::;;:: <<>> ~~##~~ ||||\n::;;:: <<>> ~~##~~ |||| ::;;::",
    "klrtp mnvbq xxzwr tgfdp qqlmn vbrtk wwzxp\npltrk qbvnm rwzxx pdfgt nmlqq ktrbv pxzww",
    "AAECAwQFBgcICQoLDA0ODxAREhMUFRYXGBkaGxwdHh8gISIjJCUmJygpKissLS4vMDEyMzQ1\nNjc4OTo7PD0+P0BBQkNERUZHSElKS0xNTk9Q",
    "��k�7� ��2�x� ���\n�q�� �9�z ��",
    "asdf jkl qwer uiop zxcv bnm asdf jkl qwer\nuiop zxcv bnm asdf jkl qwer uiop zxcv",
    "d41d8cd98f00b204e9800998ecf8427e\n9e107d9d372bb6826bd81d3542a419d6\ne4d909c290d0fb1ca068ffaddf22cbd0",
    "}{][)(><}{][)(><}{][)(><\n)(><}{][)(><}{][)(><}{][",
    "wq7 zk3 vx9 qj2 xz8 kw4 jv6 zq1 xk5 vw0\nqz3 kx7 jw9 vq2 zx4 wk8 qv6 xj1 kz5 wj0",
    "Ð¿Ñ€Ð¸ Ð²ÐµÑ‚ ÐºÐ°Ðº Ð´ÐµÐ» Ð° Ñ‚Ð²Ð¾\nÐ¸ Ð½Ð¾Ð² Ð¾ÑÑ‚ Ð¸ ÑÐµÐ³ Ð¾Ð´Ð½Ñ",
]

HOLDOUT = [(kind, text) for kind, texts in (("prose", PROSE), ("list", LIST), ("table", TABLE), ("junk", JUNK)) for text in texts]
