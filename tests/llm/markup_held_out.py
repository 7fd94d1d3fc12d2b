"""Labelled blocks the trees never see, in other words and on other matters than the table they are grown on; same notation."""

HELD_OUT = r"""
h1 <h2>The night train</h2>
p1 <p>It leaves at nine, calls at four towns and arrives before breakfast.
p0 Passengers who get off earlier are woken by the guard.
p1 Coffee is sold in the <b>second</b> car, and nowhere else, whatever the leaflet says about a bar in the last one.
n1 <ul>
l1 <li>a pillow</li>
l1 <li>two sheets, one of which is always missing</li>
n1 </ul>
p1 Tickets&nbsp;are checked twice.
p0 Fares <adult> and <child> differ by 30 %; fare < 5 is free, fare > 90 needs a form.
===
h1 # The night train
b
p1 It leaves at **nine**, calls at *four* towns and arrives before breakfast.
l1 * a pillow
l1 * two sheets, one of which is always missing on the way back from the coast
l1 + a lamp
l0 - a key
b
h1 ### Fares
t1 |Class|Fare|
n1 |-----|---:|
t1 |First|90|
t1 |Second|41|
b
n1 ```python
c0 # cheapest first
c0 fares.sort(key=lambda f: f[1])
c0 print(fares[0] ** 2)
n1 ```
p1 See [the timetable](times.md) for the days on which it does not run.
===
h1 == The night train ==
p1 It leaves at '''nine''' and calls at [[Lowbridge|four towns]] before breakfast.
l1 # Find your car.
l1 # Show the ticket to the guard, who keeps it until the morning.
l1 ** The guard has a list.
h1 === Fares ===
c0 fare := dist * 3 + 20
n1 {| class="fares"
t1 ! Class !! Fare
n1 |-
t1 | First || 90
n1 |}
p1 {{main|Fares of old}}
p1 __NOTOC__
===
h1 \section{The night train}
p1 It leaves at \emph{nine}, calls at four towns and arrives before breakfast~\cite{times}.
n1 \begin{itemize}
l1 \item a pillow
l1   \item two sheets, one of which is always missing
n1 \end{itemize}
f1 \[ f = \frac{d}{3} \]
p1 The fare is \$ 41 or 45 \% of the other one.
n1 \begin{tabular}{lr}
t1 First & 90 \\
t1 Second & 41 \\ \hline
n1 \end{tabular}
p1 Nobody sleeps. \\
===
h0 3.1 The night train
b
p0 It leaves at nine, calls at four towns and arrives before breakfast.
l0 - a pillow
l0 • two sheets, one of which is always missing
l0 3. a key
b
c0     if (fare[3] == 41 && cars != 0) { wake(guard); }
c0     path = "C:\trains\night.cfg" // read once
c0     total = a * b * c
b
f0 f = d / 3 + 20
t0 Class	Fare
t0 First	90
p0 Car #4 costs $ 41, car #5 costs $5 more; the code is {car}-{seat}, the file trains_night_4.txt.
p0 Write night_4 or night-4, not night 4 (see [2]).
===
c0 #!/usr/bin/env bash
c0 # print all fares
c0 cut -d';' -f2 fares.csv | sort -n | head
c0 export NIGHT=$HOME/night_trains
===
c0 SELECT car, avg(fare) FROM fares WHERE fare <> 0 AND car >= 4 GROUP BY car;
c0 {"car": 4, "fare": [41, 45]}
c0 2023-11-05 21:00:00 [night] INFO doors=shut delay=0
===
h0 The night train
n1 ===============
p0 It leaves at nine.
b
p0 Der Zug fährt um neun und hält in vier Städten.
p1 Der Zug fährt um <i>neun</i> und hält in vier Städten.
l1 * Der Schaffner hat eine Liste, auf der jeder Name steht.
h1 ## Preise und Klassen
l0 2) Der Schaffner weckt alle.
"""
